"""Near duplicates among embeddings: a forest of random-projection trees with spill overlap.

A tree halves the vectors by random projections until a leaf is small enough to compare all its
rows. A cut goes where fewest rows lie within a margin of it, and those rows go to both sides, so
two near vectors are parted seldom; several trees make a miss in all of them rarer still. Trees are fitted on
bounded samples, in rounds: a leaf that is still too large draws its own sample and is cut again.
Every row is then routed and compared.

Equal vectors are one row with a weight. A ball is a set of rows within half the linking angle of a
centre, so all its pairs are linked without being compared; a large group of near copies becomes
one, and its rows only meet rows outside it. Leaves are compared block against block in tasks of
bounded size, which return a count per row and a spanning set of links, never pairs.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from postlens.llm.frames import written
from postlens.operators import spanning
from postlens.operators.joins import lookup_join

COSINE = 0.95
TREES = 4
LEAF_ROWS = 2048
#: Rows of a leaf that its cuts are fitted on.
SAMPLE_ROWS = 4096
#: Rows within this distance of a cut, measured along its projection, go to both sides.
MARGIN = 0.03
#: Random directions tried for a cut.
DIRECTIONS = 24
#: A cut is made only if at most this share of the sample goes to both sides.
MOST_SPILL = 0.3
#: A ball is made of a leaf's densest place if it holds this share of the sampled rows.
BALL_SHARE = 0.1
#: Fitted cuts that are sent to the tasks at once, and a leaf's share of them: 64 cuts at most.
MODEL_BYTES = 32 << 20
CUTS = 64
SEED = 20260713
#: Tasks among which the rows of one vector with very many copies are dealt.
COPY_SALTS = 16


def usable(v) -> Column:
    """Whether a vector can link: not null, no null or non-finite component, not zero."""
    limit = float(np.finfo("float64").max)
    sound = F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= limit))
    return F.coalesce(sound & F.exists(v, lambda x: x.cast("double") != 0), F.lit(False))


def units(column) -> np.ndarray:
    """Vectors of an Arrow list column in double precision, of length one."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    z = flat.reshape(len(column), -1)
    z = z / np.abs(z).max(axis=1, keepdims=True)
    return z / np.sqrt(np.einsum("ij,ij->i", z, z))[:, None]


def _mixed(parent: int, child: int) -> int:
    """Number of a child; if two leaves ever got the same one, their rows would merely meet."""
    x = (parent * 0x9E3779B97F4A7C15 + child * 0xBF58476D1CE4E5B9 + SEED) & (2**64 - 1)
    x ^= x >> 29
    x = x * 0x94D049BB133111EB & (2**64 - 1)
    return (x ^ (x >> 32)) >> 1


# -- fitting ----------------------------------------------------------------------------------

def _cut(sample: np.ndarray, rng, margin: float):
    """(direction, threshold, low, high) of the cut with fewest rows in its margin, or None."""
    n = len(sample)
    a, b = rng.integers(0, n, DIRECTIONS), rng.integers(0, n, DIRECTIONS)
    normals = np.concatenate([sample[a] - sample[b], rng.standard_normal((DIRECTIONS, sample.shape[1]))])
    lengths = np.sqrt(np.einsum("ij,ij->i", normals, normals))
    normals = normals[lengths > 1e-9] / lengths[lengths > 1e-9, None]
    best = None
    for normal in normals:
        p = np.sort(sample @ normal)
        ranks = np.unique(np.linspace(0.25, 0.75, 33) * (n - 1)).astype(int)
        cuts = (p[ranks] + p[np.minimum(ranks + 1, n - 1)]) / 2
        low = np.searchsorted(p, cuts + margin, "right")
        high = n - np.searchsorted(p, cuts - margin, "left")
        spill = (low + high - n) / n
        cost = spill + 0.1 * np.maximum(low, high) / n
        k = int(np.argmin(cost))
        if spill[k] <= MOST_SPILL and (best is None or cost[k] < best[0]):
            best = cost[k], normal, float(cuts[k])
    return best and best[1:]


def _dense(sample: np.ndarray, cosine: float):
    """Centre of the densest place of a sample, if it holds enough rows."""
    half = np.sqrt((1 + cosine) / 2)
    part = sample[:1024]
    near = (part @ part.T) >= cosine
    around = near[int(near.sum(axis=1).argmax())]
    for _ in range(2):
        centre = part[around].mean(axis=0)
        centre /= np.sqrt(centre @ centre)
        inside = part @ centre >= half
        around = inside if inside.any() else around
    return centre if (part @ centre >= half).mean() >= BALL_SHARE else None


def fit(sample: np.ndarray, rows: float, leaf: int, balls: bool, cosine: float, margin: float, leaf_rows: int):
    """Nested cuts of a leaf of about ``rows`` rows: (centre or None, tree).

    A tree is (normal, threshold, low, high) or the number of a leaf. A place dense enough to
    fill a leaf by itself is taken out as a ball before anything is cut.
    """
    if balls:
        centre = _dense(sample, cosine)
        if centre is not None:
            return centre, leaf
    rng = np.random.default_rng([SEED, leaf % (2**63)])

    def grow(part, number):
        if len(part) * rows / len(sample) <= leaf_rows or len(part) < SAMPLE_ROWS // CUTS:
            return number
        found = _cut(part, rng, margin)
        if found is None:
            return number
        normal, at = found
        p = part @ normal
        return normal, at, grow(part[p <= at + margin], _mixed(number, 1)), grow(part[p >= at - margin], _mixed(number, 2))

    return None, grow(sample, leaf)


def route(tree, z: np.ndarray, rows: np.ndarray, margin: float):
    """(leaf, rows) pairs of the rows that fall into each leaf."""
    if not isinstance(tree, tuple):
        yield tree, rows
        return
    normal, at, low, high = tree
    p = z[rows] @ normal
    for side, child in ((p <= at + margin, low), (p >= at - margin, high)):
        if side.any():
            yield from route(child, z, rows[side], margin)


# -- the forest -------------------------------------------------------------------------------

def forest(
    rows: DataFrame, trees: int = TREES, leaf_rows: int = LEAF_ROWS, margin: float = MARGIN, cosine: float = COSINE,
) -> DataFrame:
    """``rows`` (row, weight, v) with ``leaves``, the leaves of each row, and ``ball``, the ball it is in, if any.

    Balls come from the first tree only. A leaf is full while it holds more than ``leaf_rows``
    rows outside balls; one that has no useful cut and no dense place stays as it is.
    """
    half = float(np.sqrt((1 + cosine) / 2)) * (1 + 1e-12)
    roots = [_mixed(0, t + 1) for t in range(trees)]
    placed = rows.select("row", "weight", "v", F.array(*[F.lit(r) for r in roots]).alias("leaves"),
                         F.lit(None).cast("long").alias("ball"))
    width = 8 * (rows.select(F.max(F.size("v"))).first()[0] or 1)
    first_tree, closed, turn = {roots[0]}, set(), 0
    while True:
        listed = placed.where("ball IS NULL").select("row", F.explode("leaves").alias("leaf"))
        full = listed.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > leaf_rows)
        # one row per leaf that is too large; each stands for thousands of rows
        wanted = {r.leaf: r.n for r in full.collect() if r.leaf not in closed}
        if not wanted:
            return placed
        # the others have their turn when these are cut
        some = sorted(wanted)[:max(1, MODEL_BYTES // (CUTS * width))]
        models, turn = {}, turn + 1
        for leaf, blob in _fitted(placed, [(x, wanted[x], x in first_tree) for x in some], cosine, margin, leaf_rows):
            centre, tree = pickle.loads(blob)
            if centre is None and not isinstance(tree, tuple):
                closed.add(leaf)
                continue
            if leaf in first_tree:
                first_tree |= _leaves(tree)
            models[leaf] = centre, _mixed(leaf, turn + 16), tree
        closed |= {x for x in some if x not in models}
        if models:
            placed = written(placed.mapInArrow(_router(models, half, margin), placed.schema))


def _leaves(tree) -> set:
    return {tree} if not isinstance(tree, tuple) else _leaves(tree[2]) | _leaves(tree[3])


def _fitted(placed: DataFrame, wanted: list, cosine: float, margin: float, leaf_rows: int):
    """(leaf, pickled fit): each leaf is fitted in a task, on a sample of about SAMPLE_ROWS of its rows."""
    spark = placed.sparkSession
    shares = spark.createDataFrame(
        [(leaf, n, balls, min(1.0, SAMPLE_ROWS / n)) for leaf, n, balls in wanted], "leaf long, n long, balls boolean, share double")
    chance = F.pmod(F.xxhash64("row", "leaf"), F.lit(1 << 30)) / float(1 << 30)
    # the table of wanted leaves is bounded by MODEL_BYTES
    drawn = placed.where("ball IS NULL").select("row", "v", F.explode("leaves").alias("leaf")).join(
        F.broadcast(shares), "leaf").where(chance < F.col("share"))

    def one(table):
        import pyarrow as pa

        table = table.combine_chunks()
        leaf, rows, balls = (table.column(c)[0].as_py() for c in ("leaf", "n", "balls"))
        order = np.argsort(table.column("row").to_numpy())
        found = fit(units(table.column("v").chunk(0))[order], rows, leaf, balls, cosine, margin, leaf_rows)
        return pa.table({"leaf": pa.array([leaf], pa.int64()), "fit": pa.array([pickle.dumps(found)], pa.binary())})

    fits = drawn.select("leaf", "n", "balls", "row", "v").groupBy("leaf").applyInArrow(one, "leaf long, fit binary")
    return [(r.leaf, r.fit) for r in fits.collect()]


def _router(models: dict, half: float, margin: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not len(batch):
                continue
            z = units(batch.column("v"))
            column = batch.column("leaves")
            numbers = column.flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), np.diff(column.offsets.to_numpy()))
            ball = batch.column("ball").to_pylist()
            keep = ~np.isin(numbers, list(models))
            found = [(numbers[keep], owner[keep])]
            for leaf in np.unique(numbers[~keep]):
                centre, name, tree = models[int(leaf)]
                inside = owner[numbers == leaf]
                if centre is not None:
                    for i in inside[z[inside] @ centre >= half]:
                        ball[i] = name if ball[i] is None else ball[i]
                for child, rows in route(tree, z, inside, margin):
                    found.append((np.full(len(rows), child, "int64"), rows))
            numbers, owner = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            order = np.lexsort((numbers, owner))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(batch)))]).astype("int32")
            leaves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[order]))
            columns = [batch.column(c) for c in ("row", "weight", "v")]
            yield pa.RecordBatch.from_arrays(
                [*columns, leaves, pa.array(ball, pa.int64())], names=["row", "weight", "v", "leaves", "ball"])

    return run


# -- comparing --------------------------------------------------------------------------------

def linked(placed: DataFrame, cosine: float = COSINE, block_rows: int = LEAF_ROWS) -> DataFrame:
    """(row, links, root): weight of rows linked to a row within one pair of blocks, and a row it is connected to.

    A leaf's rows outside balls and the rows of each ball in it are dealt into blocks. Two blocks of
    the same ball do not meet. A pair that shares several leaves counts in the first of them.
    """
    listed = placed.withColumn("leaf", F.explode("leaves"))
    group = F.coalesce("ball", F.lit(-1))
    counts = listed.groupBy("leaf", group.alias("g")).agg(F.count("*").alias("n"))
    parts = written(counts.withColumn("parts", F.ceil(F.col("n") / block_rows).cast("int")))
    n_parts = parts.count()
    each = parts.select("leaf", "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    one = each.select("leaf", F.struct("g", "part").alias("a"))
    other = each.select("leaf", F.struct("g", "part").alias("b"))
    apart = (F.col("a.g") == -1) | (F.col("a.g") != F.col("b.g"))
    meets = one.join(other, "leaf").where((F.col("a") <= F.col("b")) & apart)
    sides = written(meets.select("leaf", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("side")).select(
        "leaf", "a", "b", F.col("side.g").alias("g"), F.col("side.part").alias("part")))
    dealt = lookup_join(listed.withColumn("g", group), parts.select("leaf", "g", "parts"), ["leaf", "g"], "inner", rows=n_parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    spark = placed.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = ["leaf", "a", "b"]
    rows = dealt.join(sides, ["leaf", "g", "part"]).select(*keys, "g", "part", "row", "weight", "v", "leaves")

    def meet(table):
        return _meet(table, cosine)

    return rows.repartition(tasks, *keys).groupBy(*keys).applyInArrow(meet, "row long, links long, root long")


def _meet(table, cosine: float):
    """Links between two blocks of a leaf, or inside one."""
    import pyarrow as pa
    import pyarrow.compute as pc

    table = table.combine_chunks()
    row = table.column("row").to_numpy()
    weight = table.column("weight").to_numpy()
    z = units(table.column("v").chunk(0))
    first = table.column("a").chunk(0)[0].as_py()
    in_first = pc.and_(pc.equal(table.column("g"), first["g"]), pc.equal(table.column("part"), first["part"]))
    in_first = in_first.to_numpy(zero_copy_only=False)
    same = table.column("a").chunk(0)[0] == table.column("b").chunk(0)[0]
    left = np.flatnonzero(in_first)
    right = left if same else np.flatnonzero(~in_first)
    leaf = table.column("leaf")[0].as_py()
    near = np.empty((len(left), len(right)), bool)
    for start in range(0, len(left), 512):
        near[start:start + 512] = z[left[start:start + 512]] @ z[right].T >= cosine
    if same:
        np.fill_diagonal(near, False)
    links = np.zeros(len(row), "int64")
    root = np.arange(len(row))
    if near.any():
        i, j = np.nonzero(near)
        root = _roots(len(row), left[i], right[j], row)
        column = table.column("leaves").chunk(0)
        numbers = column.flatten().to_numpy()
        owner = np.repeat(np.arange(len(row)), np.diff(column.offsets.to_numpy()))
        has_link = np.zeros(len(row), bool)
        has_link[left[i]] = has_link[right[j]] = True
        earlier = (numbers < leaf) & has_link[owner]
        at_left, at_right = np.full(len(row), -1), np.full(len(row), -1)
        at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
        order = np.argsort(numbers[earlier], kind="stable")
        numbers, owner = numbers[earlier][order], owner[earlier][order]
        for inside in np.split(owner, np.flatnonzero(np.diff(numbers)) + 1) if len(numbers) else ():
            a, b = at_left[inside], at_right[inside]
            near[np.ix_(a[a >= 0], b[b >= 0])] = False
        np.add.at(links, left, near @ weight[right])
        if not same:
            np.add.at(links, right, weight[left] @ near)
    keep = (links > 0) | (root != np.arange(len(row)))
    return pa.table({"row": row[keep], "links": links[keep], "root": row[root[keep]]})


def _roots(n: int, a: np.ndarray, b: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Position of the row of smallest number that each row is connected to."""
    rank = np.empty(n, "int64")
    by_rank = np.argsort(order, kind="stable")
    rank[by_rank] = np.arange(n)
    label = rank.copy()
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[by_rank[label]]
        if (label == before).all():
            return by_rank[label]


def of_balls(placed: DataFrame) -> DataFrame:
    """(row, links, root) within balls: every row of a ball is linked to all its others."""
    inside = placed.where("ball IS NOT NULL").select("row", "weight", "ball")
    balls = written(inside.groupBy("ball").agg(F.sum("weight").alias("total"), F.min("row").alias("root")))
    return lookup_join(inside, balls, ["ball"], "inner", rows=balls.count()).select(
        "row", (F.col("total") - F.col("weight")).alias("links"), "root")


def near_duplicates(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
    trees: int = TREES, leaf_rows: int = LEAF_ROWS, margin: float = MARGIN,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``rows``.

    ``n_links`` counts the other rows with a cosine of ``cosine`` or more to this one, equal vectors included;
    ``component_id`` is the smallest id that can be reached by links. Vectors that are null,
    empty or zero, or have null or non-finite components, link with nothing. Vectors of different lengths
    do not link. Rows with the same id are rows of their own; a null id is never the smallest, unless all are null, and is not kept.
    An empty table gives no rows. Other columns are not read.
    """
    base = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v"))
    good = written(base.where(usable(F.col("v"))))
    alone = base.where(~usable(F.col("v"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    merged = good.groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"))
    distinct = written(merged.withColumn("row", F.monotonically_increasing_id()))
    found = distinct.sparkSession.createDataFrame([], "row long, links long, root long")
    # one forest per length of vectors; a table of embeddings has one
    for length in sorted(r[0] for r in distinct.select(F.size("v")).distinct().collect()):
        placed = forest(distinct.where(F.size("v") == length), trees, leaf_rows, margin, cosine)
        found = found.unionByName(of_balls(placed)).unionByName(linked(placed, cosine, leaf_rows))
    found = written(found)
    links = found.groupBy("row").agg(F.sum("links").alias("links"))
    edges = found.where("row <> root").select(F.col("row").alias("a"), F.col("root").alias("b"))
    labels = spanning.components(edges).withColumnRenamed("vec_id", "row")
    known = distinct.select("row", "first", "weight").join(links, "row", "left").join(labels, "row", "left")
    known = written(known)
    least = written(known.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least")))
    total = F.coalesce(F.col("links"), F.lit(0)) + F.col("weight") - 1
    answers = lookup_join(known, least, ["root"], rows=least.count()).select(
        "row", "first", "weight", total.alias("n_links"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    answers = written(answers)
    single = answers.where("weight = 1").select(F.col("first").alias("vec_id"), "n_links", "component_id")
    shared = distinct.where("weight > 1").select("row", "v").join(answers.select("row", "n_links", "component_id"), "row").drop("row")
    copies = lookup_join(good, written(shared), ["v"], "inner", salts=COPY_SALTS).select("vec_id", "n_links", "component_id")
    out = single.unionByName(copies).unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
