"""Columns with the names of results, ids of other types, and every character of the token encoder."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from postlens.llm import mixing, quality, queries, token_files, words as W

FOLDER = "/root/testdata/sf0.001"


def test_every_character_between_others():
    """All code points below U+3000 between letters, digits and symbols, against the library."""
    library = Tokenizer.from_file(queries.VOCABULARY)
    coder = token_files.Encoder(queries.VOCABULARY)
    points = [chr(p) for p in range(1, 0x3000)]
    texts = [f"ab{c}cd {c}. 1{c}2 {c}{c} x{c}, {c}9 !{c}? {c.upper()}e" for c in points]
    texts += ["TAKSİ, DENİZLİ.", "YENİ! GELDİ?", "İ", "İ1İ"]
    ids, lengths = coder.encode(W.strings(pa.array(texts)))
    at, wrong = 0, []
    for text, n in zip(texts, lengths):
        if ids[at:at + n].tolist() != library.encode(text, add_special_tokens=False).ids:
            wrong.append(text)
        at += n
    assert not wrong


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_vocabularies_are_refused(name):
    with pytest.raises(ValueError):
        token_files.Encoder(public_tokenizers.path(name))


def crowded(docs):
    """Documents with columns of every name that a stage adds."""
    extra = ("score", "predicted", "rate", "copy", "copies", "order", "x", "row", "class_id", "start", "part", "cdf")
    return docs.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in extra])


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    many = crowded(docs)
    for stage in (corpus_pipeline.good_quality, corpus_pipeline.mixed):
        plain, kept = stage(spark, docs, FOLDER), stage(spark, many, FOLDER)
        assert kept.columns == many.columns
        rows = sorted((r.doc_id, r.score) for r in kept.select("doc_id", "score").collect())
        assert rows == sorted((r.doc_id, f"score{r.doc_id}") for r in plain.select("doc_id").collect())


def test_mixing_of_clashing_names(spark):
    docs = crowded(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "_rate", "_copy"]
    assert mixed.where("rate = concat('rate', doc_id) AND _copy >= 1").count() == mixed.count()


def test_quality_of_text_ids(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), "quality")
    scored = quality.fit(docs, labels).score(docs, ["doc_id", "text"])
    assert scored.where("score BETWEEN 0 AND 1").count() == docs.count()
