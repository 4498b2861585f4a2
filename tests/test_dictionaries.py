"""Word lists as joined tables against the same lists as expressions; topic vocabularies of any size."""

from pyspark.sql import functions as F

import pytest

from postlens.functions import tokens as tk
from postlens.operators import models, tokens as tok
from postlens.sources import views

FOLDER = "/root/testdata/sf0.001"
PIPELINES = ["unigrams", "unigrams_keep_emojis", "bag_of_lemmas", "tagged_tokens", "phrase_features", "topic_features"]


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def texts(spark):
    extra = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "   "), (-4, "They should not sell! I'm holding steep gains. Y’all SOLD it?"), (-5, "!!!")],
        "id bigint, text string")
    given = views.texts(spark, FOLDER).select(F.col("id").cast("bigint").alias("id"), "text")
    return given.unionByName(extra).cache()


@pytest.mark.parametrize("name", PIPELINES)
def test_tables_agree_with_expressions(spark, texts, name, monkeypatch):
    run, cfg = getattr(tok, name), tok.TopicConfig()
    inline = _rows(run(texts, cfg))
    tables = tok.TopicConfig(
        stop_words=spark.createDataFrame([(w,) for w in cfg.stop_words], "word string"),
        lemmas=spark.createDataFrame(list(cfg.lemmas.items()), "form string, lemma string"),
        tags=spark.createDataFrame(list(cfg.tags.items()), "form string, tag string"))
    assert _rows(run(texts, tables)) == inline
    monkeypatch.setattr(tk, "MAX_INLINE_ENTRIES", 3)
    assert _rows(run(texts, cfg)) == inline


def _letters(i):
    return "".join(chr(97 + i // 26**k % 26) for k in range(4))


def test_dictionary_of_real_size(spark):
    forms = {f"form{_letters(i)}": f"lemma{_letters(i % 1000)}" for i in range(50_000)}
    cfg = tok.TopicConfig(lemmas=forms)
    rows = spark.createDataFrame(
        [(1, f"form{_letters(49_999)} selling form{_letters(7)}"), (2, "nothing here")], "id bigint, text string")
    got = {r.id: r.unigrams for r in tok.unigrams(rows, cfg).collect()}
    assert got == {1: [f"lemma{_letters(999)}", "selling", f"lemma{_letters(7)}"], 2: ["nothing", "here"]}


def test_vocabulary_keeps_every_term(spark):
    n = (1 << 18) + 1000
    rows = spark.range(100).select("id", F.transform(
        F.sequence(F.col("id"), F.lit(n - 1), F.lit(100)), lambda i: F.concat(F.lit("t"), i)).alias("terms"))
    counter, _ = models.tfidf_vectors(rows, "terms")
    assert len(counter.vocabulary) == n
