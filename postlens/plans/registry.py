"""Named queries and, where SQL can express them, the SQL they have to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)


def widened(df: DataFrame) -> DataFrame:
    """Integers as bigint and floats as double, so both engines show the same types."""
    def one(f):
        if isinstance(f.dataType, _INTEGERS):
            return F.col(f.name).cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)
    return df.select(*[one(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, folder: widened(fn(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
