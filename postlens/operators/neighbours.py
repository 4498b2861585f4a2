"""Exact nearest neighbours and what follows from them: core distances and fuzzy edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from postlens.operators import blocks
from postlens.operators.joins import lookup_join
from postlens.session import cut

EDGE_SCHEMA = "vec_id long, nbr long, dist double"


def copies(df: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: (vec_id, z, n_copies, first_ids).

    ``vec_id`` is the smallest id among the copies and ``first_ids`` the k + 1 smallest.
    The rank filter runs before the shuffle too, so many copies of one vector stay cheap.
    """
    rank = F.row_number().over(Window.partitionBy("z").orderBy("vec_id"))
    first = (
        df.select("vec_id", "z").withColumn("rank", rank).where(F.col("rank") <= k + 1)
        .groupBy("z").agg(F.array_sort(F.collect_list("vec_id")).alias("first_ids"))
    )
    counted = df.groupBy("z").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n_copies"))
    return counted.join(first, "z").select("vec_id", "z", "n_copies", "first_ids")


def knn(df: DataFrame, k: int, block_rows: int | None = None, spare: int = 0) -> DataFrame:
    """(vec_id, rank, nbr, dist): the ``k`` nearest other rows, ties by smaller id, and ``spare`` more with ranks above k.

    Equal vectors are searched once. Distinct vectors are cut into cells around pivots;
    the triangle inequality rules out pairs of cells that cannot hold a neighbour, and
    the remaining blocks pass by the task that owns the rows and keeps ``k`` candidates for each.
    """
    rows = df.select("vec_id", "z")
    distinct = cut(copies(rows, k + spare))
    n_rows, n_distinct = distinct.agg(F.sum("n_copies"), F.count("*")).first()
    best = _distinct_knn(distinct.select("vec_id", "z"), k + spare, block_rows)
    if n_rows == n_distinct:
        order = Window.partitionBy("vec_id").orderBy("dist", "nbr")
        return best.withColumn("rank", F.row_number().over(order)).select("vec_id", "rank", "nbr", "dist")
    return _expand_copies(rows, distinct, best, k, spare)


def _wanted_cells(cells: blocks.Cells, k: int, giving: np.ndarray | None = None) -> np.ndarray:
    """Which pairs of cells may hold neighbours of each other.

    A row of cell A has its k-th neighbour within the smallest reach that covers k + 1
    rows, where all of cell B is covered at |pivot A, pivot B| + radius A + radius B.
    Cells whose rows must be farther away than that are left out. ``giving`` counts the
    rows of each cell that may be neighbours, if not all may.
    """
    rows = cells.rows if giving is None else giving
    if not len(rows):
        return np.zeros((0, 0), bool)
    upper, lower = cells.upper(), cells.lower()
    order = np.argsort(upper, axis=1)
    covered = np.cumsum(rows[order], axis=1)
    enough = (covered > k).argmax(axis=1)
    reach = np.take_along_axis(upper, order, axis=1)[np.arange(len(upper)), enough]
    reach[covered[:, -1] <= k] = np.inf
    wanted = lower <= reach[:, None] * (1 + 1e-9) + 1e-9
    return wanted | wanted.T


def _distinct_knn(df: DataFrame, k: int, block_rows: int | None) -> DataFrame:
    rows, cells = blocks.split(df, block_rows)

    def nearest(own, others):
        return _search([(b, b.ids, b.vectors) for b in own], ((b, b.ids, b.vectors) for b in others), cells, k, True)

    found = blocks.by_owner(rows, cells, _wanted_cells(cells, k), nearest, EDGE_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy("dist", "nbr"))
    return found.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _search(own, others, cells: blocks.Cells, k: int, own_too: bool):
    """The ``k`` nearest of each row of the own (block, ids, vectors), found while the others pass by.

    A block that lies farther from a cell than all its rows' k-th candidates is passed over. Bounds of the
    distances come from matrix products; only those that may be among the k nearest are computed exactly.
    """
    import pandas as pd

    best = [(np.full((len(ids), k), np.inf), np.zeros((len(ids), k), "int64")) for _, ids, _ in own]

    def meet(o, other):
        block, _, vectors = own[o]
        there, ids, to = other
        dist, name = best[o]
        if not len(vectors) or not len(ids):
            return
        pivot, far = cells.pivots[block.cell], cells.pivots[there.cell]
        gap = np.sqrt(((pivot - far) ** 2).sum()) - cells.radius[block.cell] - cells.radius[there.cell]
        if gap * (1 - 1e-9) - 1e-9 > dist[:, -1].max():
            return
        middle = pivot if np.isfinite(pivot).all() else 0.0
        same = own_too and there.number == block.number
        for start, low, (sa, sb) in blocks.squares_below(vectors - middle, to - middle):
            at = np.arange(len(low))
            if same:
                low[at, start + at] = np.inf
            limit = dist[start:start + len(low), -1] ** 2 * (1 + 1e-12)
            if np.isinf(limit).any() and low.shape[1] >= k:
                high = low + (2 * sa[:, None] + 2 * sb[None, :])
                high[np.isnan(high)] = np.inf
                limit = np.minimum(limit, np.partition(high, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero((low <= blocks.at_least(limit, low)[:, None]) & np.isfinite(low))
            if not len(i):
                continue
            exact = blocks.exact_distances(vectors, to, start + i, j)
            keep = exact <= dist[start + i, -1]
            _merge(dist, name, start + i[keep], exact[keep], ids[j[keep]], k)

    for o in range(len(own)):
        if own_too:
            meet(o, own[o])
    for a in range(len(own)):
        for b in range(len(own)):
            if own_too and a != b:
                meet(a, own[b])
    for other in others:
        for o in range(len(own)):
            meet(o, other)
    for (_, ids, _), (dist, name) in zip(own, best):
        i, c = np.nonzero(np.isfinite(dist))
        yield pd.DataFrame({"vec_id": ids[i], "nbr": name[i, c], "dist": dist[i, c]})


def _merge(dist, name, rows, found, ids, k):
    """Put candidates (row, distance, id) into the lists of the k nearest so far."""
    touched, place = np.unique(rows, return_inverse=True)
    old = np.repeat(np.arange(len(touched)), k)
    every = np.concatenate([old, place])
    d = np.concatenate([dist[touched].ravel(), found])
    n = np.concatenate([name[touched].ravel(), ids])
    kept = _first_k(every, n, d, k)
    starts = np.searchsorted(kept["vec_id"], np.arange(len(touched)))
    column = np.arange(len(kept["vec_id"])) - starts[kept["vec_id"]]
    dist[touched[kept["vec_id"]], column] = kept["dist"]
    name[touched[kept["vec_id"]], column] = kept["nbr"]


def _first_k(ids, others, dist, k):
    """Of candidate (id, other, dist) triples, the k nearest per id."""
    order = np.lexsort((others, dist, ids))
    ids, others, dist = ids[order], others[order], dist[order]
    starts = np.r_[True, ids[1:] != ids[:-1]]
    place = np.arange(len(ids)) - np.maximum.accumulate(np.where(starts, np.arange(len(ids)), 0))
    keep = place < k
    return {"vec_id": ids[keep], "nbr": others[keep], "dist": dist[keep]}


def _expand_copies(rows: DataFrame, distinct: DataFrame, best: DataFrame, k: int, spare: int = 0) -> DataFrame:
    """Neighbour lists of all rows from those of the distinct vectors.

    The first k + 1 of a vector's own copies and its neighbours' copies are enough for
    each of its rows: at most one of them is the row itself. Where an id comes several times its list of k is shorter;
    the spare ones have ranks above k there too.
    """
    ids = distinct.select(F.col("vec_id").alias("nbr"), "first_ids")
    own = distinct.select("vec_id", F.col("vec_id").alias("nbr"), F.lit(0.0).alias("dist"), "first_ids")
    near = lookup_join(best, ids, ["nbr"], "inner").select("vec_id", "nbr", "dist", "first_ids")
    options = own.unionByName(near).select("vec_id", "dist", F.explode("first_ids").alias("nbr"))
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy("dist", "nbr"))
    lists = (
        options.withColumn("_rank", rank).where(F.col("_rank") <= k + spare + 1).groupBy("vec_id")
        .agg(F.array_sort(F.collect_list(F.struct("dist", "nbr"))).alias("near"))
    )
    by_vector = distinct.select("z", "vec_id").join(lists, "vec_id").select("z", "near")
    listed = lookup_join(rows, by_vector, ["z"], "inner")
    def others(part, n):
        return F.slice(F.filter(part, lambda e: e["nbr"] != F.col("vec_id")), 1, n)

    first = others(F.slice("near", 1, k + 1), k)
    out = listed.select("vec_id", F.posexplode(first).alias("pos", "e"))
    if spare:
        every = others(F.col("near"), k + spare)
        out = listed.select("vec_id", F.size(first).alias("own"), F.posexplode(every).alias("at", "e")).select(
            "vec_id", (F.col("at") + F.when(F.col("at") < F.col("own"), 0).otherwise(k - F.col("own"))).alias("pos"), "e")
    return out.select("vec_id", (F.col("pos") + 1).alias("rank"), F.col("e.nbr").alias("nbr"), F.col("e.dist").alias("dist"))


def core_distance(neighbours: DataFrame, k: int) -> DataFrame:
    """(vec_id, core): distance to the ``k``-th neighbour, or to the last one there is."""
    return neighbours.where(F.col("rank") <= k).groupBy("vec_id").agg(F.max("dist").alias("core"))


def with_cores(edges: DataFrame, cores: DataFrame) -> DataFrame:
    """Add ``weight``, the mutual reachability distance, to (vec_id, nbr, dist) rows."""
    cores = cut(cores)
    n = cores.count()
    ends = lookup_join(edges, cores, ["vec_id"], "inner", rows=n)
    other = cores.select(F.col("vec_id").alias("nbr"), F.col("core").alias("other_core"))
    return lookup_join(ends, other, ["nbr"], "inner", rows=n).withColumn(
        "weight", F.greatest("core", "other_core", "dist")
    )


def rho(neighbours: DataFrame) -> DataFrame:
    """Smallest positive neighbour distance of each row; 0 if all neighbours are copies."""
    positive = F.min(F.when(F.col("dist") > 0, F.col("dist")))
    return neighbours.groupBy("vec_id").agg(F.coalesce(positive, F.lit(0.0)).alias("rho"))


def bandwidths(neighbours: DataFrame, steps: int = 64) -> DataFrame:
    """(vec_id, rho, sigma, near): sigma solves sum(exp(-max(0, d - rho) / sigma)) = log2 k.

    ``near`` is the row's bounded neighbour list. The bisection runs over whole batches.
    """
    listed = neighbours.groupBy("vec_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "nbr", "dist"))).alias("near")
    ).select(
        "vec_id", F.transform("near", lambda e: e["nbr"]).alias("nbrs"),
        F.transform("near", lambda e: e["dist"]).alias("dists"),
    )

    def solve(frames):
        for frame in frames:
            if len(frame):
                rho_, sigma = _solve(frame["dists"].tolist(), steps)
                yield frame.assign(rho=rho_, sigma=sigma)

    return listed.mapInPandas(
        solve, "vec_id long, nbrs array<long>, dists array<double>, rho double, sigma double"
    )


def _solve(lists, steps):
    width = max(len(x) for x in lists)
    d = np.full((len(lists), width), np.inf)
    for i, x in enumerate(lists):
        d[i, :len(x)] = x
    count = np.isfinite(d).sum(axis=1)
    rho_ = np.where(d > 0, d, np.inf).min(axis=1)
    rho_[~np.isfinite(rho_)] = 0.0
    over = np.maximum(0.0, d - rho_[:, None])
    target = np.log2(np.maximum(count, 2))
    low, high, mid = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    for _ in range(steps):
        total = np.exp(-over / mid[:, None]).sum(axis=1)
        above = total > target
        high = np.where(above, mid, high)
        low = np.where(above, low, mid)
        mid = np.where(np.isinf(high), mid * 2, (low + high) / 2)
        mid = np.maximum(mid, 1e-12)
    return rho_, mid


def fuzzy_edges(neighbours: DataFrame) -> DataFrame:
    """(a, b, weight) with a < b: the symmetric union p + q - p * q of directed weights."""
    directed = directed_weights(neighbours)
    pair = directed.select(
        F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b"), "weight"
    )
    both = F.when(F.count("*") == 2, F.min("weight") * F.max("weight")).otherwise(F.lit(0.0))
    return pair.groupBy("a", "b").agg((F.sum("weight") - both).alias("weight"))


def directed_weights(neighbours: DataFrame) -> DataFrame:
    """(vec_id, nbr, dist, weight) with weight = exp(-max(0, d - rho) / sigma)."""
    rows = bandwidths(neighbours).select(
        "vec_id", "rho", "sigma",
        F.explode(F.arrays_zip(F.col("nbrs").alias("nbr"), F.col("dists").alias("dist"))).alias("e"),
    )
    over = F.greatest(F.lit(0.0), F.col("e.dist") - F.col("rho"))
    return rows.select(
        "vec_id", F.col("e.nbr").alias("nbr"), F.col("e.dist").alias("dist"),
        F.exp(-over / F.col("sigma")).alias("weight"),
    )


def local_radius(edges: DataFrame) -> DataFrame:
    """ln(sum(w * d^2) / sum(w)) over the edges of each row, in input space."""
    ends = edges.select("a", "b", "weight", "dist").withColumn("vec_id", F.explode(F.array("a", "b")))
    d2 = F.col("dist") * F.col("dist")
    return ends.groupBy("vec_id").agg(
        F.ln(F.sum(F.col("weight") * d2) / F.sum("weight")).alias("radius")
    )


def neighbours_of_new(new: DataFrame, fitted: DataFrame, k: int, block_rows: int | None = None) -> DataFrame:
    """(vec_id, rank, nbr, dist): the ``k`` nearest fitted rows of each new row."""
    marked = new.select("vec_id", "z", F.lit(1).alias("is_new")).unionByName(
        fitted.select("vec_id", "z", F.lit(0).alias("is_new"))
    )
    rows, cells = blocks.split(marked, block_rows)
    giving = np.zeros(len(cells.rows), "int64")
    for r in rows.where("is_new = 0").groupBy("cell").agg(F.count("*").alias("n")).collect():
        giving[r.cell] = r.n

    def nearest(own, others):
        return _search([(b, b.ids, b.vectors) for b in own], ((b, b.ids, b.vectors) for b in others), cells, k, False)

    candidates = blocks.by_owner(
        rows, cells, _wanted_cells(cells, k, giving), nearest, EDGE_SCHEMA, extra="is_new", asking=True)
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy("dist", "nbr"))
    return candidates.withColumn("rank", rank).where(F.col("rank") <= k).select("vec_id", "rank", "nbr", "dist")
