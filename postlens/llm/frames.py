"""Small helpers on DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from postlens.operators.joins import broadcast_limit
from postlens.session import shared_dir


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_rows(df: DataFrame, gone: DataFrame, rows: int) -> DataFrame:
    """``df`` without the rows whose hash of (doc_id, text) is in ``gone`` (row), which has
    ``rows`` rows. It is broadcast only if its counted size is under the session's limit."""
    name = fresh(df, "row")
    gone = gone.select(F.col("row").alias(name))
    if rows * 40 <= broadcast_limit(df):
        gone = F.broadcast(gone)
    left = df.withColumn(name, F.xxhash64("doc_id", "text")).join(gone, name, "left_anti")
    return left.select(df.columns)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder. Unlike a checkpoint it is computed once, and the
    optimiser sees its true size; sizes estimated along an iteration multiply without end."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
