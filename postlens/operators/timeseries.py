"""Activity over time: fixed time buckets, equal-width bins, and shares per bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from postlens.session import cut


def bucket(ts: Column, width: str) -> Column:
    return F.window(ts, width)["start"]


def resample(df: DataFrame, ts: str, value: Column, width: str = "3 hours", out: str = "n") -> DataFrame:
    """Aggregate per time bucket; buckets without rows are present with 0."""
    counted = df.groupBy(bucket(F.col(ts), width).alias("bucket")).agg(value.cast("bigint").alias(out))
    filled = cut(counted)  # one row per bucket, read twice
    span = filled.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    grid = span.select(F.explode(F.expr(f"sequence(lo, hi, interval {width})")).alias("bucket"))
    return grid.join(filled, "bucket", "left").select("bucket", F.coalesce(out, F.lit(0)).alias(out))


def time_bins(df: DataFrame, ts: str, bins: int) -> DataFrame:
    """Bin number 0..bins-1 of each row for equal-width, right-closed bins over the time range.
    If all times are equal the bin is 0."""
    us = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")
    span = df.agg(F.struct(F.min(us).alias("lo"), F.max(us).alias("hi"))).scalar()
    number = F.ceil(F.try_divide((us - span["lo"]) * bins, span["hi"] - span["lo"])) - 1
    return df.withColumn("bin", F.when(us.isNotNull(), F.greatest(F.lit(0), number)).cast("bigint"))


def sparse_bins(binned: DataFrame, bins: int, below: int = 100) -> DataFrame:
    """Occupancy of every bin, empty ones included, where it is under ``below``."""
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"))
    grid = counts.sparkSession.range(bins).select(F.col("id").alias("bin"))
    all_bins = grid.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    return all_bins.where(F.col("n") < below)


def shares(df: DataFrame, ts: str, label: str, width: str = "1 day") -> DataFrame:
    """Rows per (bucket, label) and their share of the bucket."""
    counts = df.groupBy(bucket(F.col(ts), width).alias("bucket"), label).agg(F.count("*").alias("n"))
    # the window runs over the counts, one row per label and bucket
    total = F.sum("n").over(Window.partitionBy("bucket"))
    return counts.select("bucket", label, "n", F.round(F.col("n") / total, 6).alias("share"))
