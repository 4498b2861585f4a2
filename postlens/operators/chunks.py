"""Re-chunking: neighbouring short sentences are joined into longer pieces.

A chunk ends where the running count of spaces passes a multiple of ``trunc_len``.
Two forms give the same rows: ``from_arrays`` works inside each post and needs no
shuffle; ``from_rows`` takes a (post, sentence number) table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlens.functions import text as tx

TRUNC_LEN = 100
_BLOCK = 64


def _with_running_sum(df: DataFrame, values: str, out: str) -> DataFrame:
    """Running sum of an array column. Appending stays inside short blocks, so a long
    array costs near linear work. Each step is its own column: an expression used
    twice would be evaluated twice."""
    def append(acc, x):
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int"))
    df = df.withColumn(
        "_blocks", F.transform(starts, lambda b: F.slice(values, b * _BLOCK + 1, _BLOCK))
    )
    df = df.withColumn(
        "_blocks",
        F.transform(
            "_blocks",
            lambda b: F.aggregate(F.slice(b, 2, _BLOCK), F.array(F.element_at(b, 1)), append),
        ),
    )
    df = df.withColumn(
        "_offsets",
        F.aggregate(
            "_blocks", F.array(F.lit(0)),
            lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.element_at(b, -1))),
        ),
    )
    shifted = F.zip_with(
        "_blocks", F.slice("_offsets", F.lit(1), F.size("_blocks")),
        lambda b, o: F.transform(b, lambda x: x + o),
    )
    return df.withColumn(out, F.flatten(shifted)).drop("_blocks", "_offsets")


def from_arrays(df: DataFrame, key: str, sentences: str, trunc_len: int = TRUNC_LEN) -> DataFrame:
    """(post_id, chunk_num, long_sent) from one array of sentences per post, row by row."""
    df = df.select(F.col(key).alias("post_id"), F.col(sentences).alias("s"))
    df = df.withColumn("spaces", F.transform("s", lambda x: tx.count_spaces(x)))
    df = _with_running_sum(df, "spaces", "running")
    df = df.withColumn("k", F.transform("running", lambda x: F.floor(x / trunc_len)))
    df = df.withColumn(
        "starts",
        F.filter(
            F.sequence(F.lit(1), F.size("s")),
            lambda i: (i == 1) | (F.get("k", i - 1) != F.get("k", i - 2)),
        ),
    )
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("s") + 1))
    pieces = F.zip_with(
        "starts", ends, lambda a, b: F.array_join(F.slice("s", a, b - a), " ")
    )
    return df.select("post_id", F.posexplode_outer(pieces).alias("chunk_num", "long_sent")).where(
        "chunk_num IS NOT NULL"
    )


def running_spaces(rows: DataFrame) -> DataFrame:
    """Add the space count of each sentence and its running sum within the post."""
    in_order = Window.partitionBy("id").orderBy("sent_num").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return rows.withColumn("space_count", tx.count_spaces("sentence")).withColumn(
        "running_spaces", F.sum("space_count").over(in_order)
    )


def from_rows(
    rows: DataFrame, trunc_len: int = TRUNC_LEN, renumber: bool = True
) -> DataFrame:
    """The same from (id, sent_num, sentence) rows: one exchange on the post id serves
    the running sum, the grouping and the renumbering."""
    keyed = running_spaces(rows).withColumn(
        "chunk_key", F.floor(F.col("running_spaces") / trunc_len).cast("bigint")
    )
    parts = F.array_sort(F.collect_list(F.struct("sent_num", "sentence")))
    joined = keyed.groupBy(F.col("id").alias("post_id"), "chunk_key").agg(
        F.array_join(F.transform(parts, lambda p: p["sentence"]), " ").alias("long_sent")
    )
    if not renumber:
        return joined
    number = F.row_number().over(Window.partitionBy("post_id").orderBy("chunk_key")) - 1
    return joined.select("post_id", number.alias("chunk_num"), "long_sent")


def keep_long(chunks: DataFrame, min_len: int = 100) -> DataFrame:
    """Drop straggling pieces of at most ``min_len`` characters."""
    return chunks.where(F.length("long_sent") > min_len)
