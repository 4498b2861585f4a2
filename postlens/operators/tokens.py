"""Token and sentence tables: one row per (post, position)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from postlens.functions import text as tx, tokens as tk
from postlens.operators.joins import lookup_join
from postlens.session import cut

# Small example lists; a caller passes its own for real work.
STOP_WORDS = (
    "the of and to a in is that it for was on with be by as this are at from "
    "don't wasn't i'm she's they've"
).split()
LEMMAS = {
    "is": "be", "was": "be", "are": "be", "had": "have", "has": "have",
    "selling": "sell", "sells": "sell", "sold": "sell", "paid": "pay", "said": "say",
}
TAGS = {
    "should": "MD", "must": "MD", "can": "MD", "not": "RB", "never": "RB", "n't": "RB",
    "do": "VBP", "sell": "VB", "hold": "VB", "say": "VB", "good": "JJ", "steep": "JJ",
}
SUFFIX_RULES = [(("tion", "ment"), "NN"), (("ly",), "RB"), (("ing",), "VB"), (("ble", "st"), "JJ")]
POLARITY = {"hold": 1, "good": 1, "moon": 1, "sell": -1, "steep": -1, "not": -1}


@dataclass(frozen=True)
class TopicConfig:
    """Word lists and switches of the token pipelines.

    Stop words, lemmas and tags may also be tables: (word), (form, lemma), (form, tag). Tables and
    lists beyond ``MAX_INLINE_ENTRIES`` are joined; shorter lists become expressions.
    """

    stop_words: list[str] | DataFrame = field(default_factory=lambda: list(STOP_WORDS))
    lemmas: dict[str, str] | DataFrame = field(default_factory=lambda: dict(LEMMAS))
    tags: dict[str, str] | DataFrame = field(default_factory=lambda: dict(TAGS))
    suffix_rules: list[tuple[tuple[str, ...], str]] = field(default_factory=lambda: list(SUFFIX_RULES))
    polarity: dict[str, int] = field(default_factory=lambda: dict(POLARITY))
    token_pattern: str = tx.TOKEN_KEEP_RE
    min_sentence: int = 3

    def keep_emojis(self) -> "TopicConfig":
        return replace(self, token_pattern=tx.TOKEN_KEEP_EMOJI_RE)


def rows_of(df: DataFrame, array, keep: list[str], pos: str, value: str) -> DataFrame:
    """One row per array element with its index.

    The outer form with a check afterwards keeps the optimiser from copying the whole
    array expression into an extra filter on "array is not empty".
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, value)).where(
        F.col(pos).isNotNull()
    )


def fenced(df: DataFrame) -> DataFrame:
    """The same rows, with columns that a later filter is not moved below.

    The optimiser moves a filter on a computed column down and copies the computation
    into it; for the costly columns here that doubles the work.
    """
    return df.select(F.inline_outer(F.array(F.struct(*df.columns))))


def word_rows(df: DataFrame, text: str = "text") -> DataFrame:
    return rows_of(df, tk.words(F.col(text)), ["id"], "pos", "word")


def token_rows(df: DataFrame, text: str = "text") -> DataFrame:
    return rows_of(df, tk.tokens(F.col(text)), ["id"], "pos", "token")


def clean_token_rows(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, pos, token): tokens cleaned and in lower case; those left empty are dropped."""
    def one(t, i):
        return F.struct(i.alias("pos"), F.lower(F.regexp_replace(t, cfg.token_pattern, "")).alias("token"))
    kept = F.filter(F.transform(tk.tokens(F.col(text)), one), lambda e: e["token"] != "")
    rows = df.select("id", F.explode_outer(kept).alias("e")).where("e IS NOT NULL")
    return rows.select("id", "e.pos", "e.token")


def sentence_rows(df: DataFrame, text: str = "text", min_len: int = 3) -> DataFrame:
    return rows_of(df, tk.sentences(F.col(text), min_len), ["id"], "sent_num", "sentence")


def sentence_features(df: DataFrame, min_len: int = 3) -> DataFrame:
    """Clean, keep-list normalise and split posts: (id, num_s, len_s, sentence)."""
    cleaned = df.select("id", tx.keep_list(tx.clean_for_embedding("text")).alias("text"))
    return sentence_rows(cleaned, min_len=min_len).select(
        "id", F.col("sent_num").alias("num_s"), F.length("sentence").alias("len_s"), "sentence"
    )


def sentence_arrays(df: DataFrame, min_len: int = 3) -> DataFrame:
    """(id, sentences) of cleaned posts, one row per post."""
    cleaned = df.select("id", tx.keep_list(tx.clean_for_embedding("text")).alias("text"))
    return cleaned.select("id", tk.sentences("text", min_len).alias("sentences"))


def lookup_sentences(texts: DataFrame, ids: DataFrame, min_len: int = 3) -> DataFrame:
    """Source text beside its sentences for the posts in ``ids``."""
    chosen = lookup_join(texts, ids.select("id").distinct(), ["id"], "left_semi")
    cleaned = tx.keep_list(tx.clean_for_embedding("text"))
    return rows_of(chosen, tk.sentences(cleaned, min_len), ["id", "text"], "sent_num", "sentence")


def remove_stop_words(rows: DataFrame, stop: DataFrame, token: str = "token") -> DataFrame:
    """Drop token rows whose lower-case form is in the ``word`` column of ``stop``."""
    keyed = rows.withColumn("_key", F.lower(token))
    words = stop.select(F.lower("word").alias("_key")).distinct()
    return lookup_join(keyed, words, ["_key"], "left_anti", rows=words.count()).drop("_key")


def lemmatise(rows: DataFrame, dictionary: DataFrame, token: str = "token") -> DataFrame:
    """Add ``lemma``: the dictionary's entry for the lower-case form, else the token."""
    keyed = rows.withColumn("_key", F.lower(token))
    forms = dictionary.groupBy(F.lower("form").alias("_key")).agg(F.min("lemma").alias("_lemma"))
    joined = lookup_join(keyed, forms, ["_key"], "left", rows=forms.count())
    return joined.withColumn("lemma", F.coalesce("_lemma", token)).drop("_key", "_lemma")


def expand_stop_words(stop: DataFrame) -> DataFrame:
    """For words with an apostrophe add the curly and the bare form, plus y'all and yall."""
    curly = F.replace("word", F.lit("'"), F.lit("’"))
    bare = F.replace("word", F.lit("'"), F.lit(""))
    extra = stop.sparkSession.createDataFrame([("y'all",), ("yall",)], "word string")
    base = stop.select("word").unionByName(extra)
    return base.select(F.explode(F.array("word", curly, bare)).alias("word")).distinct()


def _inline(*lists) -> bool:
    """Whether all word lists are short enough to be part of an expression."""
    return not any(isinstance(x, DataFrame) or len(x) > tk.MAX_INLINE_ENTRIES for x in lists)


def _entries(df: DataFrame, stop, lemmas, tags) -> DataFrame:
    """(_key, _stop, _lemma, _tag): all word lists as one table, unique in its lower-case key."""
    def table(x, *names):
        if isinstance(x, DataFrame):
            return x.toDF(*names)
        rows = list(x.items()) if isinstance(x, dict) else [(w,) for w in x]
        return df.sparkSession.createDataFrame(rows, ", ".join(f"{n} string" for n in names))

    words = table(stop, "_key").select(F.lower("_key").alias("_key"), F.lit(True).alias("_stop"))
    every = words.unionByName(table(lemmas, "_key", "_lemma"), True).unionByName(table(tags, "_key", "_tag"), True)
    return cut(every.groupBy("_key").agg(
        F.coalesce(F.max("_stop"), F.lit(False)).alias("_stop"), F.min("_lemma").alias("_lemma"), F.min("_tag").alias("_tag")))


def _looked_up(df: DataFrame, nested, entries: DataFrame) -> DataFrame:
    """``df`` with ``_found``: ``nested``, an array of token arrays, with (token, _stop, _lemma, _tag)
    for each token. Empty inner arrays are left out.

    The tokens are joined once and come back to their row through one exchange by id; text and
    other columns do not travel with them.
    """
    df = cut(df.withColumn("_nested", nested))
    rows = df.select("id", F.posexplode("_nested").alias("_outer", "_inner")).select(
        "id", "_outer", F.posexplode("_inner").alias("_pos", "token"))
    found = lookup_join(rows.withColumn("_key", F.lower("token")), entries, ["_key"], rows=entries.count())
    inner = F.array_sort(F.collect_list(F.struct("_pos", "token", "_stop", "_lemma", "_tag")))
    arrays = found.repartition("id").groupBy("id", "_outer").agg(inner.alias("_inner")).groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("_outer", "_inner"))).alias("_found"))
    joined = df.join(arrays, "id", "left")
    some = F.coalesce(F.transform("_found", lambda e: e["_inner"]), F.array().cast(
        "array<array<struct<_pos:int,token:string,_stop:boolean,_lemma:string,_tag:string>>>"))
    return joined.withColumn("_found", F.when(F.col("_nested").isNotNull(), some))


def _kept(df: DataFrame, array, stop, cfg: TopicConfig, keep=lambda t: F.lit(True)) -> tuple[DataFrame, Column]:
    """(df, array): tokens that are no stop word and pass ``keep``, lemmatised."""
    if _inline(stop, cfg.lemmas):
        return df, tk.lemmas(F.filter(tk.drop_words(array, stop), keep), cfg.lemmas)
    whole = F.when(array.isNotNull(), F.array(array))
    df = _looked_up(df, whole, _entries(df, stop, cfg.lemmas, {}))
    left = F.filter(F.flatten("_found"), lambda e: ~F.coalesce(e["_stop"], F.lit(False)) & keep(e["token"]))
    return df, F.transform(left, lambda e: F.coalesce(e["_lemma"], e["token"]))


def unigrams(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, unigrams): tokens without stop words, lemmatised, cleaned, in lower case."""
    df, array = _kept(df, tk.tokens(F.col(text)), cfg.stop_words, cfg)
    return df.select("id", tk.clean_tokens(array, cfg.token_pattern, lowercase=True).alias("unigrams"))


def unigrams_keep_emojis(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """Unigrams per sentence with multi-word exceptions kept whole and emojis kept."""
    cfg = cfg.keep_emojis()
    if _inline(cfg.stop_words):
        words = set(cfg.stop_words) | {"y'all", "yall"}
        stop = sorted(words | {w.replace("'", "’") for w in words} | {w.replace("'", "") for w in words})
    else:
        words = cfg.stop_words
        if not isinstance(words, DataFrame):
            words = df.sparkSession.createDataFrame([(w,) for w in words], "word string")
        stop = expand_stop_words(words.toDF("word"))
    pieces = tk.sentences(F.col(text), 1)
    array = F.flatten(F.transform(pieces, lambda s: tk.exception_tokens(s)))
    df, array = _kept(df, array, stop, cfg)
    dropped = cfg.token_pattern + "|http.*"
    return df.select("id", tk.clean_tokens(array, dropped, lowercase=True).alias("unigrams"))


def bag_of_lemmas(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, bow): lemma of every token that is neither a stop word nor punctuation."""
    df, array = _kept(df, tk.tokens(F.col(text)), cfg.stop_words, cfg, lambda t: t.rlike("[0-9A-Za-z]"))
    return df.select("id", array.alias("bow"))


def tagged_tokens(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, pos, token, tag)."""
    rows = token_rows(df, text)
    if not _inline(cfg.tags):
        entries = _entries(df, [], {}, cfg.tags).select("_key", "_tag")
        joined = lookup_join(rows.withColumn("_key", F.lower("token")), entries, ["_key"], rows=entries.count())
        return joined.select("id", "pos", "token", F.coalesce("_tag", tk.suffix_tag(F.col("token"), cfg.suffix_rules)).alias("tag"))
    return rows.withColumn("tag", tk.tag(F.col("token"), cfg.tags, cfg.suffix_rules))


def phrase_rows(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, phrase_no, phrase): tag-pattern phrases, sentence by sentence."""
    return rows_of(_phrases(df, cfg, text), F.col("phrases"), ["id"], "phrase_no", "phrase")


def _phrases(df: DataFrame, cfg: TopicConfig, text: str) -> DataFrame:
    pieces = tk.sentences(F.col(text), cfg.min_sentence)
    others = [c for c in df.columns if c != "id"]
    if _inline(cfg.tags):
        tagged = F.transform(pieces, lambda s: tk.tagged_sentence(s, cfg.tags, cfg.suffix_rules))
    else:
        df = _looked_up(df, F.transform(pieces, lambda s: tk.tokens(s)), _entries(df, [], {}, cfg.tags))
        tagged = F.transform("_found", lambda s: tk.tagged(s, lambda e: e["token"], lambda e: F.coalesce(
            e["_tag"], tk.suffix_tag(e["token"], cfg.suffix_rules))))
    df = df.select("id", *others, tagged.alias("_tagged"))
    found = F.flatten(F.transform("_tagged", lambda s: tk.phrases(s)))
    return df.select("id", *others, found.alias("phrases"))


def phrase_features(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, ngrams): the phrases of each post as an array of joined lemmas.

    A phrase is made of finished tokens with one space between them, so tokenising it
    again comes down to splitting at the spaces.
    """
    found = _phrases(df, cfg, text)
    if _inline(cfg.lemmas):
        lemmas = F.transform("phrases", lambda p: tk.lemmas(F.split(p, " "), cfg.lemmas))
    else:
        pieces = F.transform("phrases", lambda p: F.split(p, " "))
        found = _looked_up(found, pieces, _entries(df, [], cfg.lemmas, {}))
        lemmas = F.transform("_found", lambda p: F.transform(p, lambda e: F.coalesce(e["_lemma"], e["token"])))
    joined = F.transform(lemmas, lambda p: F.array_join(tk.clean_tokens(p, cfg.token_pattern), "_"))
    grams = F.filter(joined, lambda g: g != "")
    keep = [c for c in df.columns if c not in ("id", text)]
    return found.select("id", *keep, grams.alias("ngrams"))


def topic_features(df: DataFrame, cfg: TopicConfig, drop_empty: bool = False) -> DataFrame:
    """(id, ngrams, emojis) from raw post text, all inside the row.

    ``drop_empty`` leaves out posts without any phrase.
    """
    prepared = df.select(
        "id",
        tx.extract_emojis("text").alias("emojis"),
        tx.keep_list_for_topics(tx.clean_for_topics("text")).alias("normalised"),
    )
    out = phrase_features(prepared, cfg, "normalised").select("id", "ngrams", "emojis")
    return fenced(out).where(F.size("ngrams") > 0) if drop_empty else out


def sentiment_rows(df: DataFrame, cfg: TopicConfig, text: str = "text") -> DataFrame:
    """(id, sent_num, score, sentiment_class): 0 negative, 1 neutral, 2 positive."""
    rows = sentence_rows(df, text, cfg.min_sentence)
    weights = {}
    for word, weight in cfg.polarity.items():
        weights.setdefault(weight, []).append(word)
    rows = rows.withColumn("_tokens", F.transform(tk.tokens(F.col("sentence")), lambda t: F.lower(t)))
    score = F.lit(0)
    for weight, listed in sorted(weights.items()):
        score = score + weight * _hits(listed)
    rows = rows.withColumn("score", score)
    label = F.when(F.col("score") < 0, 0).when(F.col("score") > 0, 2).otherwise(1)
    return rows.select("id", "sent_num", "score", label.alias("sentiment_class"))


def _hits(listed):
    return F.size(F.filter("_tokens", lambda t: t.isin(listed)))
