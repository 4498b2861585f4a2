"""Queries over words, tokens, phrases and sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import text as tx, tokens as tk
from postlens.operators import stats, tokens as tok
from postlens.plans import sql_views as v
from postlens.plans.registry import query
from postlens.plans.text_queries import joined
from postlens.sources import views

CFG = tok.TopicConfig()


def _words(spark, folder):
    rows = views.titles(spark, folder).withColumn("text", F.concat_ws(" ", "title", "body"))
    return tok.word_rows(rows)


def _list_sql(values):
    return "[" + ", ".join(v.quoted(x) for x in values) + "]"


_LEMMA_ROWS = ", ".join(f"({v.quoted(f)}, {v.quoted(l)})" for f, l in tok.LEMMAS.items())


# -- words ------------------------------------------------------------------------------

@query("whitespace_words", f"""WITH {v.TITLES} SELECT id,
array_to_string({v.words("concat_ws(' ', title, body)")}, ' ') AS words FROM titles""")
def whitespace_words(spark, folder):
    rows = views.titles(spark, folder)
    return rows.select("id", joined(tk.words(F.concat_ws(" ", "title", "body")), " ").alias("words"))


@query("word_counts", f"WITH {v.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def word_counts(spark, folder):
    return stats.word_counts(_words(spark, folder))


@query("top_words", f"WITH {v.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 500")
def top_words(spark, folder):
    return stats.most_common(stats.word_counts(_words(spark, folder)))


@query("rare_words", f"WITH {v.WORDS} SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n, word DESC LIMIT 500")
def rare_words(spark, folder):
    return stats.least_common(stats.word_counts(_words(spark, folder)))


_LONGEST = f"""WITH {v.TITLES} SELECT id,
list_max(list_transform({v.words("concat_ws(' ', title, body)")}, lambda e: length(e))) AS max_string_len FROM titles"""


def _longest(spark, folder):
    rows = views.titles(spark, folder)
    lengths = F.transform(tk.words(F.concat_ws(" ", "title", "body")), lambda w: F.length(w))
    return rows.select("id", F.array_max(lengths).alias("max_string_len"))


@query("longest_word", _LONGEST)
def longest_word(spark, folder):
    return _longest(spark, folder)


@query("posts_longest_words", _LONGEST + " ORDER BY max_string_len DESC NULLS LAST, id LIMIT 3")
def posts_longest_words(spark, folder):
    return _longest(spark, folder).orderBy(F.desc_nulls_last("max_string_len"), "id").limit(3)


@query("posts_no_long_words", _LONGEST + " ORDER BY max_string_len NULLS LAST, id LIMIT 100")
def posts_no_long_words(spark, folder):
    return _longest(spark, folder).orderBy(F.asc_nulls_last("max_string_len"), "id").limit(100)


# -- tokens ------------------------------------------------------------------------------

@query("tokenize_contractions", f"WITH {v.TOKENS} SELECT id, pos, token FROM tokens")
def tokenize_contractions(spark, folder):
    return tok.token_rows(views.texts(spark, folder))


_PROTECTED = v.replace(v.replace(v.replace(v.replace(
    "text", "(\\S+) (sell|hold)([^0-9A-Za-z_]|$)", "\\1_\\2\\3"),
    "game (stop|stonk)", "game_\\1"), "\\x{1F680}\\s+", "🚀_"), "\\x{1F48E}\\x{1F64C}\\s+", "💎🙌_")
_EXCEPTION_SHAPES = r"\S+_[0-9A-Za-z]*|" + v.TOKEN_SHAPES


@query("token_exceptions", f"""WITH {v.TEXTS}, a AS (
SELECT id, {v.tokens(_PROTECTED, _EXCEPTION_SHAPES)} AS a FROM texts)
SELECT id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS token FROM a""")
def token_exceptions(spark, folder):
    return tok.rows_of(views.texts(spark, folder), tk.exception_tokens("text"), ["id"], "pos", "token")


@query("remove_stopwords", f"""WITH {v.TOKENS} SELECT id, pos, token FROM tokens
WHERE NOT {v.in_list('lower(token)', tok.STOP_WORDS)}""")
def remove_stopwords(spark, folder):
    stop = spark.createDataFrame([(w,) for w in CFG.stop_words], "word string")
    return tok.remove_stop_words(tok.token_rows(views.texts(spark, folder)), stop)


@query("expand_stopwords", f"""WITH {v.TEXTS}, w AS (
SELECT lower(unnest({v.words('text')})) AS word FROM texts),
base AS (SELECT DISTINCT word FROM w WHERE contains(word, '''') UNION SELECT unnest(['y''all', 'yall']))
SELECT DISTINCT unnest([word, replace(word, '''', '’'), replace(word, '''', '')]) AS word FROM base""")
def expand_stopwords(spark, folder):
    words = tok.word_rows(views.texts(spark, folder)).select(F.lower("word").alias("word"))
    return tok.expand_stop_words(words.where(F.col("word").contains("'")).distinct())


@query("lemmatize", f"""WITH {v.TOKENS}, d(form, lemma) AS (VALUES {_LEMMA_ROWS})
SELECT id, pos, token, coalesce(d.lemma, token) AS lemma FROM tokens LEFT JOIN d ON d.form = lower(token)""")
def lemmatize(spark, folder):
    dictionary = spark.createDataFrame(list(CFG.lemmas.items()), "form string, lemma string")
    return tok.lemmatise(tok.token_rows(views.texts(spark, folder)), dictionary)


def _unigram_sql(array, dropped, stop):
    kept = v.only(array, f"NOT {v.in_list('lower(e)', stop)}")
    lemma = v.each(kept, v.case_map("lower(e)", tok.LEMMAS, "e"))
    cleaned = v.each(lemma, f"lower({v.replace('e', dropped, '')})")
    return f"array_to_string({v.only(cleaned, chr(101) + ' <> ' + chr(39) * 2)}, ' ')"


@query("unigrams", f"""WITH {v.TEXTS} SELECT id,
{_unigram_sql(v.tokens('text'), tx.TOKEN_KEEP_RE, tok.STOP_WORDS)} AS unigrams FROM texts""")
def unigrams(spark, folder):
    rows = tok.unigrams(views.texts(spark, folder), CFG)
    return rows.select("id", joined("unigrams", " ").alias("unigrams"))


_EXPANDED = sorted({x for w in [*tok.STOP_WORDS, "y'all", "yall"]
                    for x in (w, w.replace("'", "’"), w.replace("'", ""))})
_SENTENCE_TOKENS = "flatten(" + v.each(v.sentences("text", 1), v.tokens(
    _PROTECTED.replace("(text,", "(e,"), _EXCEPTION_SHAPES)) + ")"


@query("unigrams_emoji", f"""WITH {v.TEXTS}, a AS (SELECT id, {_SENTENCE_TOKENS} AS a FROM texts)
SELECT id, {_unigram_sql('a', tx.TOKEN_KEEP_EMOJI_RE + '|http.*', _EXPANDED)} AS unigrams FROM a""")
def unigrams_emoji(spark, folder):
    rows = tok.unigrams_keep_emojis(views.texts(spark, folder), CFG)
    return rows.select("id", joined("unigrams", " ").alias("unigrams"))


_BOW = v.only(v.tokens("text"), f"NOT {v.in_list('lower(e)', tok.STOP_WORDS)} AND regexp_matches(e, '[0-9A-Za-z]')")


@query("bag_of_lemmas", f"""WITH {v.TEXTS} SELECT id,
array_to_string({v.each(_BOW, v.case_map('lower(e)', tok.LEMMAS, 'e'))}, ' ') AS bow FROM texts""")
def bag_of_lemmas(spark, folder):
    return tok.bag_of_lemmas(views.texts(spark, folder), CFG).select("id", joined("bow", " ").alias("bow"))


def _ngram_sql(n):
    ahead = ", ".join(f"lead(token, {i}) OVER w" for i in range(1, n))
    last = f"lead(token, {n - 1}) OVER w"
    return f"""WITH {v.TOKENS}, g AS (SELECT id, pos, concat_ws('_', token, {ahead}) AS ngram, {last} AS last
FROM tokens WINDOW w AS (PARTITION BY id ORDER BY pos)) SELECT id, pos, ngram FROM g WHERE last IS NOT NULL"""


def _ngrams(n):
    def run(spark, folder):
        arrays = views.texts(spark, folder).select("id", tk.tokens(F.col("text")).alias("tokens"))
        return tok.rows_of(arrays, tk.ngrams("tokens", n), ["id"], "pos", "ngram")
    return run


query("ngrams_2", _ngram_sql(2))(_ngrams(2))
query("ngrams_3", _ngram_sql(3))(_ngrams(3))


# -- tags and phrases ----------------------------------------------------------------------

def _tag_sql(x):
    cases = " ".join(f"WHEN lower({x}) = {v.quoted(w)} THEN {v.quoted(t)}" for w, t in tok.TAGS.items())
    rules = [("(tion|ment)$", "NN"), ("ly$", "RB"), ("ing$", "VB"), ("(ble|st)$", "JJ")]
    cases += " ".join(f" WHEN regexp_matches(lower({x}), {v.quoted(p)}) THEN {v.quoted(t)}" for p, t in rules)
    return f"CASE {cases} ELSE 'NN' END"


_PATTERNS = [r"(?:\S+/JJ )+\S+/NN ", r"(?:\S+/NN )+\S+/NN ", r"(?:\S+/MD )+(?:\S+/RB )*\S+/VB ",
             r"(?:\S+/VBP )*(?:\S+/RB )*(?:\S+/VB )+\S+/NN "]


def _phrases_cte(source, text):
    """(id, sent, pattern, match, phrase) from sentence and token rows."""
    union = " UNION ALL ".join(
        f"SELECT id, sent, {i} AS pattern, generate_subscripts(m, 1) AS match, unnest(m) AS raw "
        f"FROM (SELECT id, sent, {v.extract('tagged', p)} AS m FROM tagged)" for i, p in enumerate(_PATTERNS))
    return f"""s0 AS (SELECT id, {v.sentences(text)} AS s FROM {source}),
s1 AS (SELECT id, generate_subscripts(s, 1) AS sent, unnest(s) AS sentence FROM s0),
s2 AS (SELECT id, sent, {v.tokens('sentence')} AS t FROM s1),
s3 AS (SELECT id, sent, generate_subscripts(t, 1) AS pos, unnest(t) AS token FROM s2),
tagged AS (SELECT id, sent, string_agg(concat(token, '/', {_tag_sql('token')}, ' '), '' ORDER BY pos) AS tagged
FROM s3 GROUP BY id, sent),
raws AS ({union}),
phrases AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY sent, pattern, match) - 1 AS phrase_no,
trim({v.replace('raw', '/[A-Z]+ ', ' ')}) AS phrase FROM raws)"""


_NORMALISED = f"normalised AS (SELECT id, text, {v.keep_for_topics(v.for_topics('text'))} AS clean FROM texts)"
_FEATURE = v.only(v.each(v.each(v.tokens("phrase"), v.case_map("lower(e)", tok.LEMMAS, "e")),
                         v.replace("e", tx.TOKEN_KEEP_RE, "")), "e <> ''")
_FEATURES = f"""{v.TEXTS}, {_NORMALISED}, {_phrases_cte('normalised', 'clean')},
grams AS (SELECT id, phrase_no, array_to_string({_FEATURE}, '_') AS ngram FROM phrases),
listed AS (SELECT id, string_agg(ngram, '|' ORDER BY phrase_no) AS ngrams FROM grams WHERE ngram <> '' GROUP BY id)"""


def _normalised(spark, folder):
    return views.texts(spark, folder).select(
        "id", tx.keep_list_for_topics(tx.clean_for_topics("text")).alias("text")
    )


@query("pos_tag", f"WITH {v.TOKENS} SELECT id, pos, token, {_tag_sql('token')} AS tag FROM tokens")
def pos_tag(spark, folder):
    return tok.tagged_tokens(views.texts(spark, folder), CFG)


@query("pos_phrases", f"WITH {v.TEXTS}, {_NORMALISED}, {_phrases_cte('normalised', 'clean')} SELECT * FROM phrases")
def pos_phrases(spark, folder):
    return tok.phrase_rows(_normalised(spark, folder), CFG)


@query("phrase_features", f"WITH {_FEATURES} SELECT id, coalesce(ngrams, '') AS ngrams FROM texts LEFT JOIN listed USING (id)")
def phrase_features(spark, folder):
    rows = tok.phrase_features(_normalised(spark, folder), CFG)
    return rows.select("id", joined("ngrams").alias("ngrams"))


@query("topic_features", f"""WITH {_FEATURES} SELECT id, coalesce(ngrams, '') AS ngrams,
array_to_string({v.extract('text', v.EMOJI)}, '|') AS emojis FROM texts LEFT JOIN listed USING (id)""")
def topic_features(spark, folder):
    rows = tok.topic_features(views.texts(spark, folder), CFG)
    return rows.select("id", joined("ngrams").alias("ngrams"), joined("emojis").alias("emojis"))


# -- sentiment -------------------------------------------------------------------------------

_POLARITY = "CASE lower(token) " + " ".join(
    f"WHEN {v.quoted(w)} THEN {s}" for w, s in tok.POLARITY.items()) + " ELSE 0 END"
SENTIMENT = f"""s0 AS (SELECT id, {v.sentences('text')} AS s FROM texts),
s1 AS (SELECT id, generate_subscripts(s, 1) - 1 AS sent_num, unnest(s) AS sentence FROM s0),
s2 AS (SELECT id, sent_num, unnest({v.tokens('sentence')}) AS token FROM s1),
s3 AS (SELECT id, sent_num, CAST(sum({_POLARITY}) AS BIGINT) AS score FROM s2 GROUP BY id, sent_num),
sentiment AS (SELECT id, sent_num, coalesce(score, 0) AS score,
CASE WHEN score < 0 THEN 0 WHEN score > 0 THEN 2 ELSE 1 END AS sentiment_class
FROM s1 LEFT JOIN s3 USING (id, sent_num))"""


@query("sentence_sentiment", f"WITH {v.TEXTS}, {SENTIMENT} SELECT * FROM sentiment")
def sentence_sentiment(spark, folder):
    return tok.sentiment_rows(views.texts(spark, folder), CFG)


@query("sentiment_counts", f"""WITH {v.TEXTS}, {SENTIMENT} SELECT sentiment_class,
CASE sentiment_class WHEN 0 THEN '-' WHEN 2 THEN '+' ELSE 'Ⓝ' END AS mark, count(*) AS n FROM sentiment GROUP BY ALL""")
def sentiment_counts(spark, folder):
    mark = F.when(F.col("sentiment_class") == 0, "-").when(F.col("sentiment_class") == 2, "+").otherwise("Ⓝ")
    rows = tok.sentiment_rows(views.texts(spark, folder), CFG)
    return rows.groupBy("sentiment_class").agg(F.count("*").alias("n")).withColumn("mark", mark)
