"""Joins against lookup tables whose keys may be very unevenly used."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

MAX_SALTS = 64
#: Bytes of a counted table in one task of a wide join up to which it is hashed, not sorted.
MAX_HASHED = 32 << 20


def plan_bytes(df: DataFrame) -> int:
    """Size estimate of a plan, as the optimiser sees it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except ValueError:
        # estimates multiply along long plans, to numbers with thousands of digits
        return 1 << 62


def row_bytes(df: DataFrame) -> int:
    """Bytes of one row in a broadcast table, with room for its overhead. For strings this
    is a word, not a text: tables of texts or arrays are not counted by rows."""
    names = [f.dataType.typeName() for f in df.schema.fields]
    return 32 + sum(64 if n == "string" else 16 for n in names)


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast bound in bytes; negative means never."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    number = re.fullmatch(r"(-?\d+)([kmgt]?)b?", text.strip().lower())
    return int(number[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[number[2]]


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
    salts: int | None = None, limit: int | None = None, rows: int | None = None,
) -> DataFrame:
    """Join ``big`` with a table that is unique in ``on``.

    The table is broadcast when its size is below the limit. Its size is ``rows`` times the
    width of a row of numbers if the caller has counted it, else the optimiser's estimate. Beyond it each key is
    spread over ``salts`` tasks and the table is repeated once per salt, so one key with
    a large share of the rows does not end in one task. If the caller has counted the table and its share of
    a task is small, the share is hashed there, which spares sorting the many rows of ``big``.
    """
    limit = broadcast_limit(big) if limit is None else limit
    size = plan_bytes(lookup) if rows is None else rows * row_bytes(lookup)
    if size <= limit:
        return big.join(F.broadcast(lookup), on, how)
    if salts is None:
        cores = big.sparkSession.sparkContext.defaultParallelism
        salts = max(2, min(MAX_SALTS, cores // 2))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(big)), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    tasks = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None and size * salts <= MAX_HASHED * tasks:
        repeated = repeated.hint("shuffle_hash")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f.name) for f in df.schema.fields if f.dataType.typeName() != "map"]
