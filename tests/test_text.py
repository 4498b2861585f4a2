"""Cleaning, sentences, tokens and phrases on hand-made texts."""

import pytest
from pyspark.sql import functions as F

from postlens.functions import text as tx, tokens as tk
from postlens.operators import chunks, tokens as tok

CFG = tok.TopicConfig()


@pytest.fixture
def value(spark):
    def run(expr, text):
        df = spark.createDataFrame([(0, text)], "id long, text string")
        return df.select(expr(F.col("text")).alias("x")).first().x
    return run


@pytest.mark.parametrize("text, expected", [
    ("a “b” ‘c’ wasn’t", "a \"b\" 'c' wasn't"),
    ("plain", "plain"),
])
def test_quotes(value, text, expected):
    assert value(tx.straighten_quotes, text) == expected


def test_links_entities_and_asterisks_become_spaces(value):
    assert value(tx.strip_links, "see https://a.b/c?d now *bold* &#x200B; x") == "see   now  bold    x"


def test_line_breaks_dashes_and_dots_become_stops(value):
    assert value(tx.break_to_stop, "a\n- b... c- d") == "a. . b.  c. d"


def test_emojis_are_replaced_and_kept_in_order(value):
    text = "go 🚀🚀 👱‍♀️ 💎🙌"
    assert value(tx.strip_emojis, text) == "go" + " " * 8
    assert value(tx.extract_emojis, text) == ["🚀", "🚀", "👱‍♀️", "💎", "🙌"]


@pytest.mark.parametrize("text, expected", [
    ("🚀", "🚀"), ("Hey 🚀🚀🚀", "Hey 🚀"), ("Hey 🚀 🚀 🚀 x", "Hey 🚀x"), ("💎🙌 💎🙌", "💎🙌 💎🙌"),
])
def test_emoji_runs(value, text, expected):
    assert value(lambda t: tx.collapse_runs(t, ["🚀", "💎", "🙌"]), text) == expected


def test_very_long_runs_do_not_overflow(value):
    assert value(lambda t: tx.collapse_runs(t, ["🚀"]), "🚀 " * 50_000) == "🚀"
    assert value(lambda t: F.size(tk.tokens(t)), "a" * 300_000) == 1
    tagged = "x/JJ " * 50_000 + "y/NN "
    assert value(lambda t: F.size(tk.phrases(t)), tagged) == 1


def test_skin_tones(value):
    assert value(tx.strip_skin_tone, "👋🏽👋🏿👋") == "👋👋👋"


def test_keep_list(value):
    assert value(tx.keep_list, " é(a)  b#c, $5! ") == "a b c, $5!"


@pytest.mark.parametrize("text, expected", [
    ("I'm sure she's here; they've sold.", ["I", "'m", "sure", "she", "'s", "here", ";", "they", "'ve", "sold", "."]),
    ("wasn't it? Don't!", ["was", "n't", "it", "?", "Do", "n't", "!"]),
    ("S&P 5% $100", ["S&P", "5%", "$100"]),
    ("it's's I'dx's", ["it", "'s", "'s", "I", "'dx", "'s"]),
])
def test_contractions(value, text, expected):
    assert value(tk.tokens, text) == expected


def test_exceptions_stay_whole(value):
    assert value(tk.exception_tokens, "Do not sell, game stop now") == ["Do", "not_sell", ",", "game_stop", "now"]


def test_sentences(value):
    assert value(tk.sentences, "One here. No? Yes!! x. last") == ["One here.", "No?", "Yes!!", "last"]
    assert value(tk.sentences, "") == []


def test_wrap(value):
    import textwrap

    text = "the quick brown fox jumps over the lazy dog again and again until the line is full"
    assert value(tx.wrap, text) == "<br>".join(textwrap.wrap(text, 40))
    assert value(tx.wrap, "x" * 95) == "<br>".join(["x" * 40, "x" * 40, "x" * 15])


def test_ngrams(value):
    assert value(lambda t: tk.ngrams(tk.words(t), 2), "a b c") == ["a_b", "b_c"]
    assert value(lambda t: tk.ngrams(tk.words(t), 3), "a b") == []


def test_phrases(spark):
    texts = ["You should not sell now.", "a steep price", "I do not sell gme", "🚀"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = {r.id: (r.ngrams, r.emojis) for r in tok.topic_features(df, CFG).collect()}
    assert "should_not_sell" in rows[0][0]
    assert "steep_price" in rows[1][0]
    assert "do_not_sell_gme" in rows[2][0]
    assert rows[3] == ([], ["🚀"])
    kept = {r.id for r in tok.topic_features(df, CFG, drop_empty=True).collect()}
    assert kept == {0, 1, 2}


def test_unigrams(spark):
    df = spark.createDataFrame([(0, "She's selling the GME, it was paid!")], "id long, text string")
    got = tok.unigrams(df, CFG).first().unigrams
    assert "sell" in got and "pay" in got and "the" not in got and "," not in got


def test_sentiment(spark):
    df = spark.createDataFrame([(0, "Good moon. Do not sell. It is there.")], "id long, text string")
    rows = [(r.sent_num, r.score, r.sentiment_class) for r in tok.sentiment_rows(df, CFG).orderBy("sent_num").collect()]
    assert rows == [(0, 2, 2), (1, -2, 0), (2, 0, 1)]


def test_stop_words_and_lemmas_by_join(spark):
    rows = spark.createDataFrame([(0, 0, "The"), (0, 1, "Sold"), (0, 2, "x")], "id long, pos int, token string")
    stop = spark.createDataFrame([("the",)], "word string")
    kept = tok.remove_stop_words(rows, stop)
    assert sorted(r.token for r in kept.collect()) == ["Sold", "x"]
    lemmas = spark.createDataFrame([("sold", "sell")], "form string, lemma string")
    assert {r.token: r.lemma for r in tok.lemmatise(kept, lemmas).collect()} == {"Sold": "sell", "x": "x"}


def test_inline_lists_have_a_limit():
    with pytest.raises(ValueError):
        tk.drop_words(F.col("x"), [str(i) for i in range(tk.MAX_INLINE_ENTRIES + 1)])


def test_both_chunk_forms_agree_with_a_loop(spark):
    import random

    rnd = random.Random(3)
    posts = {i: [" ".join("w" * rnd.randint(1, 5) for _ in range(rnd.randint(1, 160)))
                 for _ in range(rnd.choice([0, 1, 3, 64, 65, 200]))] for i in range(8)}
    want = set()
    for post, sentences in posts.items():
        groups, total = {}, 0
        for s in sentences:
            total += s.count(" ")
            groups.setdefault(total // 100, []).append(s)
        want |= {(post, n, " ".join(groups[k])) for n, k in enumerate(sorted(groups))}
    arrays = spark.createDataFrame(list(posts.items()), "id long, s array<string>")
    assert {tuple(r) for r in chunks.from_arrays(arrays, "id", "s").collect()} == want
    rows = tok.rows_of(arrays, "s", ["id"], "sent_num", "sentence")
    assert {tuple(r) for r in chunks.from_rows(rows).collect()} == want


def test_patterns_that_look_at_one_character_first_find_the_same(spark):
    texts = ["http://x.y * &&##x200B; h #x x200Bq hhttp:q &x", "a- b -\n- c.. .d...e\r\n-", "“a” ‘b’ 🚀é 👱‍♀️ 💎", "", None,
             "n't don't '$ab% =x ñandú 'Ab", "‘’‚‛“”„ 🌀🪨"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = df.select(
        F.regexp_replace("text", r"http\S+|&*#*x200B\S*|\*", " "), F.regexp_replace("text", r"[\n\r]|- |[.]{2,}", ". "),
        F.translate("text", "“”‘’", "\"\"''"), F.regexp_replace("text", tx.EMOJI_RE, " "),
        F.regexp_extract_all("text", F.lit(tx.EMOJI_RE), F.lit(0)),
        F.array_join(F.regexp_extract_all("text", F.lit(r"[0-9A-Za-z$&%.,?!'‘’\"“”]+"), F.lit(0)), " "),
        F.regexp_extract_all("text", F.lit(r"n't|'[a-z]+|[0-9A-Za-z$&%=]+|[^\sA-Za-z0-9]"), F.lit(0)))
    found = df.select(
        tx.strip_links("text"), tx.break_to_stop("text"), tx.straighten_quotes("text"), tx.strip_emojis("text"),
        tx.extract_emojis("text"), tx.keep_list("text"), F.regexp_extract_all("text", F.lit(tk.TOKEN_RE), F.lit(0)))
    assert found.collect() == plain.collect()
    for pattern in (tx.LINK_RE, tx.BREAK_RE):
        assert pattern.startswith("(?=[")
