"""Low-dimensional layout of a neighbour graph by attraction along edges and repulsion."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from postlens.operators import blocks, neighbours, vectors
from postlens.operators.joins import lookup_join
from postlens.operators.ordering import with_position
from postlens.session import cut

REPEL_SAMPLES = 5
CLIP = 4.0
# rows whose edges one task works on, and its steps between two exchanges
LAYOUT_ROWS = 2048
EPOCHS = 10
# rows of the whole layout that a task repels from besides its own
SAMPLE_ROWS = 2048
# half the width of the box that a layout starts in
BOX = 10.0


def curve(min_dist: float = 0.1, spread: float = 1.0) -> tuple[float, float]:
    """(alpha, beta) for which 1 / (1 + alpha * d^(2 beta)) is closest to a curve that is 1
    up to ``min_dist`` and then falls off exponentially."""
    x = np.linspace(0, spread * 3, 300)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    alpha, beta = 1.0, 1.0
    for _ in range(100):
        power = x ** (2 * beta)
        fit = 1 / (1 + alpha * power)
        by_alpha = -fit**2 * power
        by_beta = -fit**2 * alpha * power * 2 * np.log(x)
        step, *_ = np.linalg.lstsq(np.stack([by_alpha, by_beta], 1), y - fit, rcond=None)
        alpha, beta = alpha + 0.5 * step[0], beta + 0.5 * step[1]
    return float(alpha), float(beta)


def fit(
    df: DataFrame, dim: int = 2, n_neighbors: int = 15, steps: int = 200, min_dist: float = 0.1,
    density_weight: float = 0.0, block_rows: int | None = None, layout_rows: int | None = None, epochs: int | None = None,
) -> DataFrame:
    """(vec_id, z) with ``dim`` components from (vec_id, z).

    Starts from a random projection. Each step pulls rows together along edges, drawn by their
    weight, and pushes both ends from a few random rows, with a rate that falls to zero.
    ``density_weight`` > 0 also pulls each row's local radius in the layout towards its
    radius in the input.

    Edges are packed once into blocks of ``layout_rows`` rows that list them as neighbours, at most
    ``n_neighbors`` a row however popular its other ends are. A task has the coordinates of the
    rows of one block and of those at the other ends, and takes ``epochs`` steps on its own. Then blocks
    exchange: a row that several blocks moved takes the mean of its moves, weighted by its edges
    there. So there are ``steps / epochs`` rounds of jobs, and a row with very many neighbours is not thrown about.
    """
    layout_rows, epochs = layout_rows or LAYOUT_ROWS, epochs or EPOCHS
    rows = cut(df.select("vec_id", "z"))
    near = cut(neighbours.knn(rows, n_neighbors, block_rows))
    # rows of a cell are close to each other, so most edges stay inside a block
    cells, _ = blocks.split(rows, block_rows)
    numbered = cut(with_position(cells.select("cell", "vec_id", "z"), ["cell", "vec_id"]))
    n = numbered.count()
    place = numbered.select("vec_id", "position")
    i, j = place.toDF("owner", "i"), place.toDF("other", "j")
    edges = lookup_join(lookup_join(_owned(near), i, ["owner"], "inner", rows=n), j, ["other"], "inner", rows=n)
    graph = cut(edges.select(F.floor(F.col("i") / layout_rows).cast("long").alias("block"), "i", "j", "weight", "dist"))
    packed = cut(graph.groupBy("block").applyInArrow(_pack, PACKED))
    needs = cut(graph.select("block", F.explode(F.array("i", "j")).alias("i")).distinct())
    force = curve(min_dist)
    coords = cut(_started(numbered, dim))
    target = _centred(_radius(_both_ends(graph).withColumn("d2", F.col("dist") * F.col("dist")))) if density_weight > 0 else None
    names = [f"y{c}" for c in range(dim)]
    for first in range(0, steps, epochs):
        rates = [1.0 - step / steps for step in range(first, min(steps, first + epochs))]
        if target is None:
            known = coords.withColumn("gap", F.lit(0.0))
        else:
            now = _centred(_radius(_with_distance(graph, coords, n, dim))).withColumnRenamed("radius", "now")
            gap = target.join(now, "i").select("i", (density_weight * (F.col("radius") - F.col("now"))).alias("gap"))
            known = coords.join(gap, "i", "left").withColumn("gap", F.coalesce("gap", F.lit(0.0)))
        # a bounded number of rows, drawn anew each round
        drawn = coords.orderBy(F.xxhash64("i", F.lit(first))).limit(SAMPLE_ROWS).select(*names).toArrow()
        sample = np.stack([drawn.column(c).to_numpy() for c in names], axis=1)
        run = _descent(sample, n, rates, force, first, dim)
        local = lookup_join(needs, known, ["i"], "inner", rows=n)
        moved = packed.groupBy("block").cogroup(local.groupBy("block")).applyInArrow(
            run, "i long, w double, " + ", ".join(f"g{c} double" for c in range(dim)))
        total = moved.groupBy("i").agg(*[(F.sum(F.col("w") * F.col(f"g{c}")) / F.sum("w")).alias(f"g{c}") for c in range(dim)])
        coords = cut(coords.join(total, "i", "left").select("i", *[
            (F.col(f"y{c}") + F.coalesce(f"g{c}", F.lit(0.0))).alias(f"y{c}") for c in range(dim)]))
    out = coords.select(F.col("i").alias("position"), F.array(*names).alias("z"))
    return place.join(out, "position").select("vec_id", "z")


def _owned(near: DataFrame) -> DataFrame:
    """(owner, other, weight, dist): each edge once, owned by a row that has the other in its list."""
    pair = neighbours.directed_weights(near).select(
        F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b"), "vec_id", "weight", "dist")
    both = F.when(F.count("*") == 2, F.min("weight") * F.max("weight")).otherwise(F.lit(0.0))
    edges = pair.groupBy("a", "b").agg(
        F.min("vec_id").alias("owner"), (F.sum("weight") - both).alias("weight"), F.min("dist").alias("dist"))
    other = F.when(F.col("owner") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return edges.select("owner", other.alias("other"), "weight", "dist")


def _started(numbered: DataFrame, dim: int) -> DataFrame:
    """(i, y0, y1, ...): a random projection, scaled to a box of fixed size around its mean."""
    width = len(numbered.select("z").first().z)
    projected = vectors.random_projection(numbered.select(F.col("position").alias("i"), "z"), width, dim)
    flat = cut(projected.select("i", *vectors.columns("z", dim, "y")))
    names = [f"y{c}" for c in range(dim)]
    facts = flat.agg(*[f(c).alias(f"{k}_{c}") for c in names for k, f in (("avg", F.avg), ("lo", F.min), ("hi", F.max))]).first()
    half = max((facts[f"hi_{c}"] - facts[f"lo_{c}"]) / 2 for c in names) or 1.0
    return flat.select("i", *[((F.col(c) - facts[f"avg_{c}"]) * (BOX / half)).alias(c) for c in names])


PACKED = "block long, ids binary, heads binary, tails binary, weights binary"


def _pack(table):
    """Edges of a block with its rows numbered from 0."""
    import pyarrow as pa

    i, j, w = (table.column(c).to_numpy() for c in ("i", "j", "weight"))
    order = np.lexsort((j, i))
    ids, ends = np.unique(np.concatenate([i[order], j[order]]), return_inverse=True)
    ends = ends.astype("int32")
    cells = (ids.astype("int64"), ends[:len(i)], ends[len(i):], w[order])
    return pa.table({"block": table.column("block").combine_chunks()[:1]} | {
        name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("ids", "heads", "tails", "weights"), cells)})


def _descent(sample, n: int, rates, force, seed: int, dim: int):
    """Steps of one block between two exchanges: moves of its rows, and their number of edges there."""
    alpha, beta = force

    def run(packed, local):
        import pyarrow as pa

        row = packed.to_pylist()[0]
        ids = np.frombuffer(row["ids"], "int64")
        heads, tails = np.frombuffer(row["heads"], "int32"), np.frombuffer(row["tails"], "int32")
        weights = np.frombuffer(row["weights"], "float64")
        order = np.argsort(local.column("i").to_numpy())
        y = np.stack([local.column(f"y{c}").to_numpy() for c in range(dim)], axis=1)[order]
        gap = local.column("gap").to_numpy()[order]
        start = y.copy()
        rng = np.random.default_rng([seed, row["block"]])
        for rate in rates:
            due = rng.permutation(np.flatnonzero(rng.random(len(weights)) < weights))
            for k in range(0, len(due), max(16, len(ids) // 2)):
                e = due[k:k + max(16, len(ids) // 2)]
                y += rate * _step(y, heads[e], tails[e], weights[e], gap, sample, n, rng, alpha, beta)
        counts = np.bincount(heads, minlength=len(ids)) + np.bincount(tails, minlength=len(ids))
        return pa.table({"i": ids, "w": counts.astype("float64")} | {f"g{c}": y[:, c] - start[:, c] for c in range(dim)})

    return run


def _pull(diff, d2, alpha, beta):
    safe = np.where(d2 > 0, d2, 1.0)
    coef = np.where(d2 > 0, -2 * alpha * beta * safe ** (beta - 1) / (1 + alpha * safe**beta), 0.0)
    return np.clip(coef[:, None] * diff, -CLIP, CLIP)


def _push(diff, d2, alpha, beta):
    coef = 2 * beta / ((0.001 + d2) * (1 + alpha * d2**beta))
    return np.clip(coef[:, None] * diff, -CLIP, CLIP)


def _step(y, h, t, w, gap, sample, n, rng, alpha, beta):
    """Move of every row by some edges: together along them, and both ends away from random rows."""
    diff = y[h] - y[t]
    d2 = np.einsum("ij,ij->i", diff, diff)
    along = _pull(diff, d2, alpha, beta)
    ends = np.concatenate([h, t])
    move = np.concatenate([along, -along])
    if gap.any():
        spread = (w / (1 + d2))[:, None] * diff
        move += np.clip(np.concatenate([gap[h, None] * spread, -gap[t, None] * spread]), -CLIP, CLIP)
    for _ in range(REPEL_SAMPLES):
        # rows of the block stand for themselves, the others for the sample
        near = rng.random(len(ends)) < len(y) / n
        away = np.where(near[:, None], y[rng.integers(len(y), size=len(ends))], sample[rng.integers(len(sample), size=len(ends))])
        diff = y[ends] - away
        move += _push(diff, np.einsum("ij,ij->i", diff, diff), alpha, beta)
    total = np.stack([np.bincount(ends, move[:, c], minlength=len(y)) for c in range(y.shape[1])], axis=1)
    return np.clip(total, -CLIP, CLIP)


def _both_ends(graph):
    return graph.select(F.explode(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))).alias("e"),
                        "weight", "dist").select("e.i", "e.j", "weight", "dist")


def _with_distance(graph, coords, n, dim):
    """(i, weight, d2): squared length of each edge in the layout, from both ends."""
    other = coords.select(F.col("i").alias("j"), *[F.col(f"y{c}").alias(f"x{c}") for c in range(dim)])
    ends = lookup_join(lookup_join(graph, coords, ["i"], "inner", rows=n), other, ["j"], "inner", rows=n)
    d2 = reduce(lambda a, b: a + b, [(F.col(f"y{c}") - F.col(f"x{c}")) * (F.col(f"y{c}") - F.col(f"x{c}")) for c in range(dim)])
    return ends.select(F.explode(F.array("i", "j")).alias("i"), "weight", d2.alias("d2"))


def _radius(rows):
    return rows.groupBy("i").agg(
        F.ln(F.sum(F.col("weight") * F.col("d2")) / F.sum("weight") + 1e-8).alias("radius"))


def _centred(radii):
    radii = cut(radii)
    mean, spread = radii.agg(F.avg("radius"), F.stddev_pop("radius")).first()
    return radii.select("i", ((F.col("radius") - F.lit(mean)) / max(spread or 0.0, 1e-8)).alias("radius"))


def place_new(
    new: DataFrame, fitted: DataFrame, coords: DataFrame, k: int = 15, steps: int = 0, min_dist: float = 0.1,
) -> DataFrame:
    """(vec_id, z): new rows on the layout ``coords`` of the fitted rows.

    Each starts at the weighted mean of the coordinates of its ``k`` nearest fitted rows. With
    ``steps`` it then descends as in ``fit``, but only new rows move, so they need nothing of each
    other and all steps are taken in one pass over them.
    """
    near = cut(neighbours.neighbours_of_new(new, fitted, k))
    weights = neighbours.directed_weights(near).select("vec_id", "nbr", "weight")
    at = lookup_join(weights, coords.select(F.col("vec_id").alias("nbr"), "z"), ["nbr"], "inner")
    if steps:
        at = cut(at)
    parts = at.select("vec_id", "weight", F.posexplode("z").alias("c", "x"))
    means = parts.groupBy("vec_id", "c").agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x"))
    listed = F.array_sort(F.collect_list(F.struct("c", "x")))
    placed = means.groupBy("vec_id").agg(F.transform(listed, lambda p: p["x"]).alias("z"))
    if not steps:
        return placed
    # at most k neighbours a row, and a bounded sample to be pushed from
    lists = at.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("nbr", "weight", "z"))).alias("ends"))
    drawn = coords.orderBy(F.xxhash64("vec_id")).limit(SAMPLE_ROWS).select("z").collect()
    sample = np.array([r.z for r in drawn], "float64")
    alpha, beta = curve(min_dist)

    def run(frames):
        for frame in frames:
            if len(frame):
                yield frame[["vec_id"]].assign(z=list(_settle(frame, sample, steps, alpha, beta)))

    return placed.join(lists, "vec_id").mapInPandas(run, "vec_id long, z array<double>")


def _settle(frame, sample, steps, alpha, beta):
    """Coordinates of a batch of new rows after their descent among fixed rows."""
    y = np.array(frame["z"].tolist(), "float64")
    width = max(len(e) for e in frame["ends"])
    weight, at = np.zeros((len(y), width)), np.zeros((len(y), width, y.shape[1]))
    for i, ends in enumerate(frame["ends"]):
        for k, e in enumerate(ends):
            weight[i, k], at[i, k] = e["weight"], e["z"]
    # rows draw by their own number, so a row moves alike in any batch
    rngs = [np.random.default_rng([9, int(v) & 0x7FFFFFFFFFFFFFFF]) for v in frame["vec_id"]]
    for step in range(steps):
        rate = 1.0 - step / steps
        chance = np.stack([r.random(width) for r in rngs])
        picks = np.stack([r.integers(len(sample), size=(width, REPEL_SAMPLES)) for r in rngs])
        for k in range(width):
            due = chance[:, k] < weight[:, k]
            diff = y - at[:, k]
            move = _pull(diff, np.einsum("ij,ij->i", diff, diff), alpha, beta)
            for s in range(REPEL_SAMPLES):
                diff = y - sample[picks[:, k, s]]
                move += _push(diff, np.einsum("ij,ij->i", diff, diff), alpha, beta)
            y += rate * due[:, None] * np.clip(move, -CLIP, CLIP)
    return y.tolist()
