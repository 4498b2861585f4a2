"""Vector arithmetic, projections, centroids and cluster quality measures."""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from postlens.operators import blocks
from postlens.operators.joins import lookup_join

#: Distance sums that a task holds before it hands them on.
OWN_SUMS = 8_000_000


def distance(a, b) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def columns(z: str, n: int, prefix: str = "z") -> list[Column]:
    """One named column per component."""
    return [F.get(z, F.lit(i)).alias(f"{prefix}{i}") for i in range(n)]


def projection_signs(dim: int, target: int) -> list[list[float]]:
    """Sign matrix of the random projection, a fixed function of the two indices."""
    def sign(i, j):
        return 1.0 if hashlib.md5(f"{i}_{j}".encode()).hexdigest()[0] < "8" else -1.0
    return [[sign(i, j) for i in range(dim)] for j in range(target)]


def random_projection(df: DataFrame, dim: int, target: int, z: str = "z") -> DataFrame:
    """Replace ``z`` by ``target`` signed sums of its components."""
    scale = math.sqrt(target)
    sums = []
    for row in projection_signs(dim, target):
        signs = F.array(*[F.lit(x) for x in row])
        products = F.zip_with(z, signs, lambda x, s: x * s)
        sums.append(F.aggregate(products, F.lit(0.0), lambda a, x: a + x) / scale)
    return df.withColumn(z, F.array(*sums))


def centroids(df: DataFrame, cluster: str = "cluster", z: str = "z") -> DataFrame:
    """(cluster, centre, n): component means, combined before the shuffle."""
    parts = df.select(cluster, F.posexplode(z).alias("i", "x"))
    means = parts.groupBy(cluster, "i").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy(cluster).agg(
        F.transform(ordered, lambda p: p["x"]).alias("centre"), F.max("n").alias("n")
    )


def nearest_centre(df: DataFrame, centres: DataFrame, z: str = "z") -> DataFrame:
    """Assign each row to its nearest centre. The centres reach the rows as one array."""
    listed = centres.agg(F.array_sort(F.collect_list(F.struct("cluster", "centre")))).scalar()
    best = F.array_min(
        F.transform("_centres", lambda c: F.struct(distance(z, c["centre"]).alias("d"), c["cluster"].alias("c")))
    )
    rows = df.withColumn("_centres", listed).withColumn("_best", best)
    return rows.withColumn("cluster", F.col("_best.c")).withColumn("dist", F.col("_best.d")).drop(
        "_best", "_centres"
    )


def davies_bouldin(df: DataFrame) -> DataFrame:
    """Mean over clusters of the worst ratio of spread to centre distance (small is good)."""
    centres = centroids(df)
    spread = (
        lookup_join(df, centres.select("cluster", "centre"), ["cluster"], "inner")
        .groupBy("cluster").agg(F.avg(distance("z", "centre")).alias("s"))
    )
    table = centres.join(spread, "cluster").select("cluster", "centre", "s")
    listed = table.agg(F.collect_list(F.struct("cluster", "centre", "s"))).scalar()
    ratios = F.transform(
        F.filter("others", lambda c: c["cluster"] != F.col("cluster")),
        lambda c: (F.col("s") + c["s"]) / distance("centre", c["centre"]),
    )
    return table.withColumn("others", listed).select(F.array_max(ratios).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def _listed(own, total, count):
    """(vec_id, own, cluster, total, n) of the sums of each own block, cluster by cluster."""
    import pandas as pd

    for left, sums in zip(own, total):
        for name, column in sums.items():
            yield pd.DataFrame({
                "vec_id": left.ids, "own": left.extra, "cluster": np.full(len(left.ids), name, "int64"),
                "total": column, "n": np.full(len(left.ids), count[name], "int64")})


def silhouette_rows(df: DataFrame, block_rows: int | None = None) -> DataFrame:
    """(vec_id, cluster, silhouette) with Euclidean distances to all rows.

    All blocks pass by the task that owns a row; it returns one distance sum per row
    and cluster, never the distances themselves.
    """
    rows, cells = blocks.split(df, block_rows)
    schema = "vec_id long, own long, cluster long, total double, n long"

    def sums(own, others):
        total = [{} for _ in own]
        count = {}
        for right in itertools.chain(own, others):
            names, place, n = np.unique(right.extra, return_inverse=True, return_counts=True)
            one_hot = np.zeros((len(right.ids), len(names)))
            one_hot[np.arange(len(right.ids)), place] = 1.0
            for name, m in zip(names.tolist(), n.tolist()):
                count[name] = count.get(name, 0) + m
            for left, sums_ in zip(own, total):
                middle = left.vectors.mean(axis=0)
                tiles = blocks.distance_tiles(left.vectors - middle, right.vectors - middle)
                part = np.concatenate([tile @ one_hot for _, tile in tiles])
                for c, name in enumerate(names.tolist()):
                    sums_[name] = sums_[name] + part[:, c] if name in sums_ else part[:, c].copy()
            if len(count) * sum(len(b.ids) for b in own) > OWN_SUMS:
                yield from _listed(own, total, count)
                total, count = [{} for _ in own], {}
        yield from _listed(own, total, count)

    parts = blocks.by_owner(rows, cells, None, sums, schema, extra="cluster", most_blocks=8)
    per_cluster = parts.groupBy("vec_id", "own", "cluster").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")
    )
    own = F.col("own") == F.col("cluster")
    per_row = per_cluster.groupBy("vec_id", F.col("own").alias("cluster")).agg(
        F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return per_row.select("vec_id", "cluster", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def silhouette(df: DataFrame) -> DataFrame:
    return silhouette_rows(df).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_squared(df: DataFrame) -> DataFrame:
    """Silhouette with squared distances, linear in the rows: the mean squared distance
    to a cluster follows from its size, its mean and its mean square."""
    square = F.aggregate("z", F.lit(0.0), lambda s, x: s + x * x)
    rows = df.withColumn("sq", square)
    sizes = rows.groupBy("cluster").agg(F.avg("sq").alias("mean_sq"))
    table = centroids(df).join(sizes, "cluster")
    listed = table.agg(F.collect_list(F.struct("cluster", "centre", "mean_sq", "n"))).scalar()

    def mean_square(c):
        dot = F.aggregate(F.zip_with("z", c["centre"], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        return F.struct(
            c["cluster"].alias("c"), (F.col("sq") - 2 * dot + c["mean_sq"]).alias("m"), c["n"].alias("n")
        )

    rows = rows.withColumn("_all", listed).withColumn("_m", F.transform("_all", mean_square))
    own = F.get(F.filter("_m", lambda m: m["c"] == F.col("cluster")), F.lit(0))
    others = F.transform(F.filter("_m", lambda m: m["c"] != F.col("cluster")), lambda m: m["m"])
    rows = rows.withColumn("_own", own).withColumn("b", F.array_min(others))
    rows = rows.withColumn("a", F.try_divide(F.col("_own.m") * F.col("_own.n"), F.col("_own.n") - 1))
    value = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return rows.select("vec_id", "cluster", F.coalesce(value, F.lit(0.0)).alias("silhouette")).agg(
        F.avg("silhouette").alias("silhouette")
    )
