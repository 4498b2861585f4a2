"""Counts, distributions and reports over posts, words and cluster labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F


def word_counts(words: DataFrame, column: str = "word") -> DataFrame:
    """Frequency of each word; counts are combined before the shuffle."""
    return words.groupBy(F.col(column).alias("word")).agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, n: int = 500) -> DataFrame:
    return counts.orderBy(F.desc("n"), "word").limit(n)


def least_common(counts: DataFrame, n: int = 500) -> DataFrame:
    return counts.orderBy("n", F.desc("word")).limit(n)


def key_is_unique(df: DataFrame, key: str) -> DataFrame:
    """Two-step count: rows per key, then totals. A repeated key is counted before the shuffle."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count("*").alias("n_keys"),
        (F.sum("n") == F.count("*")).alias("is_unique"),
    )


def value_counts(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(out))


def wide_counts(counts: DataFrame, column: str, values: list | None = None) -> DataFrame:
    """Counts as one row with a column per value, by default per value that occurs."""
    if values is None:
        # the values become the columns of the result, so the driver has to know them
        values = sorted(r[0] for r in counts.where(F.col(column).isNotNull()).select(column).distinct().collect())
    cells = [F.sum(F.when(F.col(column) == v, F.col("n"))).cast("bigint").alias(f"c{v}") for v in values]
    return counts.agg(*cells)


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of an integer column.

    Values are counted first, so the exact quartiles work on distinct values only. The
    deviation of a single row is null.
    """
    v, n = F.col(column), F.col("n")
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    total = F.sum("n")
    mean = F.sum(v * n) / total
    variance = F.try_divide(F.sum(v.cast("double") * v * n) - total * mean * mean, total - 1)
    return counted.agg(
        total.cast("bigint").alias("n_rows"),
        F.round(mean, 6).alias("mean"),
        F.round(F.sqrt(variance), 4).alias("std"),
        F.min(v).cast("bigint").alias("min"),
        *[F.expr(f"percentile({column}, {q}, n)").alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
        F.max(v).cast("bigint").alias("max"),
    )


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins; the upper edge is in the last bin, values outside are left out."""
    width = (high - low) / bins
    place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("bigint")
    inside = df.where(F.col(column).between(low, high))
    return inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"))


def density(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density of an integer column on an even grid.

    Equal values are counted first, then each grid point sums over the distinct values. A
    constant column has no width, and its density is null.
    """
    counted = df.groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    total = F.sum("n")
    mean = F.sum(F.col("v") * F.col("n")) / total
    variance = F.try_divide(F.sum(F.col("v") * F.col("v") * F.col("n")) - total * mean * mean, total - 1)
    facts = counted.agg(
        F.struct(
            total.alias("n"), (F.sqrt(variance) * F.pow(total, F.lit(-0.2))).alias("h"),
            F.min("v").alias("lo"), F.max("v").alias("hi"),
        ).alias("facts")
    )
    f = facts.scalar()
    span = f["hi"] - f["lo"]
    start = f["lo"] - span / 2
    step = span * 2 / (points - 1)
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i)
    placed = counted.select("v", "n", F.explode(grid).alias("point"), f["h"].alias("h"),
                            start.alias("start"), step.alias("step"), f["n"].alias("total"))
    x = F.col("start") + F.col("point") * F.col("step")
    z = F.try_divide(x - F.col("v"), F.col("h"))
    kernel = F.try_divide(F.col("n") * F.exp(-z * z / 2), F.col("total") * F.col("h") * math.sqrt(2 * math.pi))
    return placed.groupBy("point").agg(
        F.round(F.first(x), 6).alias("x"), F.round(F.sum(kernel), 6).alias("density")
    )


def batches(df: DataFrame, size: int = 32) -> DataFrame:
    n = F.count("*")
    return df.agg(n.alias("n_rows"), F.ceil(n / size).cast("bigint").alias("n_batches"))


def dominant(df: DataFrame, column: str, threshold: int = 200) -> DataFrame:
    """Values with more than ``threshold`` rows, and what share of all rows they hold."""
    sizes = value_counts(df, column)
    total = sizes.agg(F.sum("n")).scalar()
    return sizes.where(F.col("n") > threshold).withColumn("share", F.round(F.col("n") / total, 6))


def noise_share(df: DataFrame, column: str, noise: int = -1) -> DataFrame:
    is_noise = (F.col(column) == noise).cast("int")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.sum(is_noise).cast("bigint").alias("n_noise"),
        F.round(F.avg(is_noise), 6).alias("noise_share"),
    )


def size_lists(sizes: DataFrame, by: list[str], head: int = 20, skip: int = 0) -> DataFrame:
    """Cluster sizes per parameter combination, largest first, as one text.

    ``sizes`` holds one row per cluster. ``skip`` leaves out the leading sizes.
    """
    ranked = _ranked(sizes, by).where((F.col("rank") > skip) & (F.col("rank") <= skip + head))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "n"))), lambda p: p["n"].cast("string"))
    return ranked.groupBy(*by).agg(F.array_join(listed, ",").alias("sizes"))


def _ranked(sizes: DataFrame, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("n"), "cluster")
    return sizes.withColumn("rank", F.row_number().over(order))


def pick_smallest_maximum(sizes: DataFrame, by: list[str], low: int, high: int) -> DataFrame:
    """Among combinations with between ``low`` and ``high`` clusters (both excluded), the
    one or more whose largest cluster is smallest."""
    grid = sizes.groupBy(*by).agg(
        F.count("*").alias("num_clusters"), F.max("n").alias("largest")
    ).where((F.col("num_clusters") > low) & (F.col("num_clusters") < high))
    return grid.where(F.col("largest") == grid.agg(F.min("largest")).scalar())


def pick_by_nth_largest(
    sizes: DataFrame, by: list[str], nth: int = 6, at_least: int = 600, show: int = 10
) -> DataFrame:
    """Combinations whose ``nth`` largest cluster has more than ``at_least`` rows."""
    good = _ranked(sizes, by).where((F.col("rank") == nth) & (F.col("n") > at_least)).select(*by)
    return size_lists(sizes, by, head=show).join(good, by, "left_semi")


def best_scores(scores: DataFrame) -> DataFrame:
    """The parameters with the largest silhouette and with the smallest Davies-Bouldin index."""
    key = F.struct("d", "k")
    best = scores.agg(
        F.max_by(key, F.struct(F.col("silhouette"), -F.col("d"), -F.col("k"))).alias("s"),
        F.max("silhouette").alias("silhouette"),
        F.min_by(key, F.struct(F.col("db"), F.col("d"), F.col("k"))).alias("b"),
        F.min("db").alias("db"),
    )
    return best.select(
        F.explode(F.array(
            F.struct(F.lit("silhouette").alias("metric"), F.col("s.d").alias("d"),
                     F.col("s.k").alias("k"), F.col("silhouette").alias("value")),
            F.struct(F.lit("davies_bouldin").alias("metric"), F.col("b.d").alias("d"),
                     F.col("b.k").alias("k"), F.col("db").alias("value")),
        )).alias("r")
    ).select("r.*")


def key_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, counted with repeats, that are more frequent on one side than on the other."""
    def counted(df, sign):
        return df.groupBy(*keys).agg((F.count("*") * sign).alias("n"))
    both = counted(left, 1).unionByName(counted(right, -1))
    return both.groupBy(*keys).agg(F.sum("n").cast("bigint").alias("surplus")).where("surplus <> 0")


def compare_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    n_left = left.agg(F.count("*").alias("n_left"))
    return n_left.withColumn("n_right", right.agg(F.count("*")).scalar()).withColumn(
        "equal", F.col("n_left") == F.col("n_right")
    )


def same_vectors(left: Column, right: Column) -> Column:
    """True when two arrays agree in length and in every element."""
    return (F.size(left) == F.size(right)) & F.forall(
        F.zip_with(left, right, lambda a, b: a.eqNullSafe(b)), lambda e: e
    )


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 1) -> DataFrame:
    """Bernoulli sample without replacement, repeatable for any partitioning."""
    text = F.concat(F.col(key).cast("string"), F.lit(f"_{seed}"))
    value = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(value < int(fraction * 4294967296))


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """Random sample of exactly ``n`` rows (all rows if there are fewer)."""
    text = F.concat(F.col(key).cast("string"), F.lit(f"_{seed}"))
    return df.withColumn("_order", F.md5(text)).orderBy("_order", key).limit(n).drop("_order")
