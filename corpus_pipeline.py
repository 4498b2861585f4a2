"""From documents to token files: quality, near duplicates, benchmark passages, mixing, tokens."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from postlens.llm import decontaminate, mixing, near_dedup, quality, queries, token_files
from postlens.llm.frames import fresh
from postlens.plans.registry import QUERIES, widened
from postlens.session import shared_dir
from postlens.sources import readers


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, gives label 1."""
    labels = readers.table(spark, sf_dir, "labels")
    score, predicted = fresh(docs, "score"), fresh(docs, "predicted")
    scored = quality.fit(docs, labels).score(docs, docs.columns, score, predicted)
    return scored.where(F.col(predicted) == 1).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that of the smallest id."""
    return near_dedup.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, readers.table(spark, sf_dir, "benchmark"), partial=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that sources weigh the same, in shuffled order."""
    return mixing.mix(docs).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixed corpus: place, length and checksum of each copy."""
    return token_files.read(spark, token_files.write(docs, queries.VOCABULARY, ordered=False))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("tokens", tokens),
]
#: The classifier, the sketches and the tokenizer have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = readers.table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES["pipeline"] = lambda spark, sf_dir: widened(run(spark, sf_dir))
