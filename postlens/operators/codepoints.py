"""Study of the code points that occur in text: ranges, regex classes, emoji sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from postlens.functions import text as tx
from postlens.operators.ordering import with_position
from postlens.operators.tokens import rows_of


def distinct_codes(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct code points; characters are made distinct inside each row first."""
    chars = F.array_distinct(F.split(F.col(text), ""))
    rows = df.select(F.explode_outer(chars).alias("c")).where("c <> ''")
    return rows.select(F.ascii("c").alias("cp")).distinct()


def ranges(codes: DataFrame) -> DataFrame:
    """Runs of consecutive code points: (first, last, size).

    There are at most 0x110000 code points, so the unpartitioned window is bounded.
    """
    island = F.col("cp") - F.row_number().over(Window.orderBy("cp"))
    return (
        codes.select("cp", island.alias("island")).groupBy("island")
        .agg(F.min("cp").alias("first"), F.max("cp").alias("last"))
        .select("first", "last", (F.col("last") - F.col("first") + 1).alias("size"))
    )


def large(found: DataFrame, at_least: int = 20) -> DataFrame:
    return found.where(F.col("size") >= at_least)


def expand(found: DataFrame) -> DataFrame:
    """One row per code point of each range."""
    return found.select(F.explode(F.sequence("first", "last")).alias("cp"))


def isolated(found: DataFrame, below: int = 20) -> DataFrame:
    return expand(found.where(F.col("size") < below)).select("cp", F.lower(F.hex("cp")).alias("hex"))


def regex_class(found: DataFrame) -> DataFrame:
    r"""All ranges as one regex character class, ``\x{a}-\x{b}`` in code point order."""
    piece = F.concat(
        F.lit("\\x{"), F.lower(F.hex("first")), F.lit("}-\\x{"), F.lower(F.hex("last")), F.lit("}")
    )
    pieces = F.array_sort(F.collect_list(F.struct("first", piece.alias("piece"))))
    joined = F.array_join(F.transform(pieces, lambda p: p["piece"]), "")
    return found.agg(F.concat(F.lit("["), joined, F.lit("]")).alias("regex_class"))


def sequences(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct emoji sequences with their hex codes: (emoji, codes, n_codes)."""
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(tx.EMOJI_SEQUENCE_RE), F.lit(0)))
    rows = df.select(F.explode_outer(found).alias("emoji")).where("emoji IS NOT NULL").distinct()
    return rows.withColumn("codes", tx.hex_codes("emoji")).withColumn("n_codes", F.size("codes"))


def sequence_lengths(found: DataFrame) -> DataFrame:
    """Sequences per code count 1, 2 and 3 or more, and the longest of each group."""
    group = F.least("n_codes", F.lit(3)).alias("code_group")
    text = F.array_join("codes", " ")
    return found.groupBy(group).agg(
        F.count("*").alias("n"),
        F.max(F.struct("n_codes", text.alias("codes")))["codes"].alias("longest"),
    )


def sequence_delta(found: DataFrame) -> DataFrame:
    """Sequences of several codes in order, each shown by what differs from the one before.

    Only sequences with as many codes as the previous row are compared; equal codes
    become empty.
    """
    several = found.where("n_codes > 1").select("codes", F.array_join("codes", " ").alias("code_text"))
    ordered = with_position(several, ["code_text"])
    before = ordered.select((F.col("position") + 1).alias("position"), F.col("codes").alias("before"))
    rows = ordered.join(before, "position", "left")
    changed = F.zip_with("codes", "before", lambda a, b: F.when(a == b, F.lit("")).otherwise(a))
    same_size = F.size("codes") == F.size(F.coalesce("before", F.array()))
    return rows.select(
        "code_text",
        F.array_join(F.when(same_size, changed).otherwise(F.col("codes")), ",").alias("delta"),
    )


def char_differences(df: DataFrame, left: str, right: str) -> DataFrame:
    """(id, position, left_code, right_code) wherever two texts differ, position by position."""
    pairs = F.zip_with(
        F.split(left, ""), F.split(right, ""),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    rows = rows_of(df.where(F.col(left) != F.col(right)), pairs, ["id"], "position", "p")
    return rows.where("p.a <> p.b").select(
        "id", "position",
        F.hex(F.ascii("p.a")).alias("left_code"), F.hex(F.ascii("p.b")).alias("right_code"),
    )
