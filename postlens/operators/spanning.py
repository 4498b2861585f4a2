"""Minimum spanning trees over all pairs of rows, and connected components."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from postlens.operators import blocks
from postlens.operators.joins import lookup_join
from postlens.operators.neighbours import copies, with_cores
from postlens.session import cut

TREE_SCHEMA = "a long, b long, weight double"
# a remainder of the graph below this many edges is finished in one task
TAIL_EDGES = 2_000_000
# weights are compared and returned with nine decimals
WEIGHT_UNIT = 1e9
# neighbours beyond the core distance that lists should have, so that they decide more edges of a tree
SPARE = 10
# components that are few enough for a table of their pairs
FEW = 64


def reachability_tree(
    df: DataFrame, cores: DataFrame, block_rows: int | None = None, tail_edges: int | None = None,
    near: DataFrame | None = None,
) -> DataFrame:
    """(a, b, weight) with a < b: the minimum spanning tree of the complete graph of mutual
    reachability distances, ties ordered by (weight, a, b).

    The tree of a whole graph lies within the trees of its blocks and of the pairs of
    blocks. Two groups of blocks meet in a task, which grows these trees with numpy and returns
    those of their edges that span its rows; the edges of all tasks are then reduced to one tree.
    Copies of a row hang on its first copy, at their common core distance.

    ``near`` are neighbour lists, from which most edges of the tree follow (``_certain``). Blocks then
    compare only rows that these edges do not connect yet.
    """
    rows = df.select("vec_id", "z")
    distinct = cut(copies(rows, 0).select("vec_id", "z", "n_copies"))
    n_rows, n_distinct, n_ids = distinct.agg(F.sum("n_copies"), F.count("*"), F.count_distinct("vec_id")).first()
    with_core = lookup_join(distinct.select("vec_id", "z"), cores, ["vec_id"], "inner", rows=n_rows)
    certain, reach = None, None
    if near is None or n_ids < n_distinct:  # an id of several vectors has no list of its own
        labelled = with_core.select("vec_id", "z", "core", F.col("vec_id").alias("comp"), F.lit(float("-inf")).alias("bound"))
    else:
        certain, found, reach = _certain(near, cores, rows, distinct, n_rows, n_distinct, tail_edges)
        labelled = cut(lookup_join(with_core, found, ["vec_id"], rows=n_distinct).select(
            "vec_id", "z", "core", F.coalesce("comp", "vec_id").alias("comp"), F.coalesce("bound", F.lit(float("-inf"))).alias("bound")))
        if reach is not None:
            labelled = _within(labelled, *reach)
    if certain is not None and labelled.isEmpty():
        return _with_copies(spanning_forest(certain, tail_edges), rows, distinct, cores, n_rows, n_distinct)
    split_rows, cells = blocks.split(_tagged(labelled), block_rows)

    def meeting(pairs):
        return _meeting_tree(pairs, reach)

    edges = blocks.by_meeting(split_rows, cells, _wanted_cells(cells, split_rows), meeting, TREE_SCHEMA, extra="tags")
    if certain is not None:
        edges = edges.unionByName(certain)
    edges = cut(edges)  # read several times below, and costly
    if certain is not None or int(cells.parts.sum()) > 1:
        edges = spanning_forest(edges, tail_edges)
    return _with_copies(edges, rows, distinct, cores, n_rows, n_distinct)


def _with_copies(edges, rows, distinct, cores, n_rows, n_distinct):
    """The tree of the different vectors with the copies of each on its first row."""
    if n_rows == n_distinct:
        return edges
    first = distinct.select("z", F.col("vec_id").alias("a"))
    stars = lookup_join(rows, first, ["z"], "inner").where("vec_id <> a")
    weight = cores.select(F.col("vec_id").alias("a"), F.round("core", 9).alias("weight"))
    stars = lookup_join(stars, weight, ["a"], "inner", rows=n_rows).select("a", F.col("vec_id").alias("b"), "weight")
    return edges.unionByName(stars)


def _certain(near, cores, rows, distinct, n_rows, n_distinct, tail_edges):
    """(edges, rows, reach): edges that hold the part of the tree that neighbour lists decide, (vec_id, comp, bound) with the
    components they make, and how far apart these may be.

    A row that is not in the list of another is at least as far from it as ``bound``, the last of the list. So the
    lightest listed edge that leaves a component is the lightest of all, if it is lighter than that for every row of it.
    Components without such an edge wait for others to join them, or for the blocks. If few are left, ``reach`` is
    (names, table): no edge between two of them is needed that is longer than the way over listed edges.
    """
    listed = near
    if n_rows != n_distinct:
        first = distinct.select("z", F.col("vec_id").alias("first"))
        names = lookup_join(rows, first, ["z"], "inner").select(F.col("vec_id").alias("nbr"), "first").distinct()
        listed = lookup_join(near, distinct.select("vec_id"), ["vec_id"], "left_semi", rows=n_distinct)
        listed = lookup_join(listed, names, ["nbr"], "inner", rows=n_rows).select("vec_id", F.col("first").alias("nbr"), "dist")
    weight = F.rint(F.col("weight") * WEIGHT_UNIT) / WEIGHT_UNIT
    edges = cut(with_cores(listed, cores).where("vec_id <> nbr").groupBy(
        F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b")).agg(F.min(weight).alias("weight")))
    # two units less, as products and differences of vectors may round otherwise
    bounds = cut(listed.groupBy("vec_id").agg((F.rint(F.max("dist") * WEIGHT_UNIT - 2) / WEIGHT_UNIT).alias("bound")))
    forest, labels = _rounds(edges, tail_edges, bounds)
    found = labels.select("vec_id", F.col("root").alias("comp")).join(bounds, "vec_id", "left")
    few = [r.root for r in labels.select("root").distinct().orderBy("root").limit(FEW + 1).collect()]
    if len(few) > FEW:
        return forest, found, None
    names, at = np.array(few, "int64"), {c: i for i, c in enumerate(few)}
    one, other = (labels.select(F.col("vec_id").alias(e), F.col("root").alias(f"c{e}")) for e in "ab")
    n = n_distinct
    ends = lookup_join(lookup_join(edges, one, ["a"], "inner", rows=n), other, ["b"], "inner", rows=n).where("ca <> cb")
    light = ends.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(
        F.min(F.struct("weight", "a", "b")).alias("m")).select("x", "y", "m.*").collect()
    table = np.full((len(few), len(few)), np.inf)
    for e in light:
        table[at[e.x], at[e.y]] = table[at[e.y], at[e.x]] = e.weight
    for middle in range(len(few)):
        np.minimum(table, np.maximum(table[:, middle, None], table[None, middle]), out=table)
    np.fill_diagonal(table, -np.inf)
    joining = edges.sparkSession.createDataFrame([(e.a, e.b, e.weight) for e in light], TREE_SCHEMA)
    return forest.unionByName(joining), found, (names, table)


def _within(rows: DataFrame, names: np.ndarray, table: np.ndarray) -> DataFrame:
    """The rows that may have an edge to another component; rows without a list are kept."""
    far = [(int(c), float(x)) for c, x in zip(names, table.max(axis=1, initial=-np.inf))]
    far = rows.sparkSession.createDataFrame(far, "comp long, far double")
    near = F.col("far").isNull() | (F.greatest("core", "bound") <= F.col("far") + 2 / WEIGHT_UNIT)
    return cut(rows.join(F.broadcast(far), "comp", "left").where(near).select("vec_id", "z", "core", "comp", "bound"))


def _tagged(rows: DataFrame) -> DataFrame:
    """(vec_id, z, core, comp, tags) with ``tags`` the bits of the core distance, the component and the bits of the bound."""
    def tag(batches):
        import pyarrow as pa

        for batch in batches:
            core, comp, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("core", "comp", "bound"))
            cells = np.stack([core.view("int64"), comp, bound.view("int64")], axis=1).ravel()
            tags = pa.ListArray.from_arrays(pa.array(np.arange(0, len(cells) + 1, 3, dtype="int32")), pa.array(cells))
            columns = [batch.column(c) for c in ("vec_id", "z", "core", "comp")]
            yield pa.RecordBatch.from_arrays([*columns, tags], names=["vec_id", "z", "core", "comp", "tags"])

    return rows.mapInArrow(tag, rows.select("vec_id", "z", "core", "comp", F.array("comp").alias("tags")).schema)


def _wanted_cells(cells: blocks.Cells, rows: DataFrame) -> np.ndarray:
    """Pairs of cells that can hold an edge of the tree.

    Along the best chain of cells between two of them, rows are joined by steps that are
    no longer than the largest distance between neighbouring cells of the chain. An edge
    longer than every step of that chain closes a cycle and is not needed. Nor is one between two cells whose
    rows are all in one component.
    """
    low, high = np.zeros(len(cells.rows)), np.zeros(len(cells.rows))
    one = [None] * len(cells.rows)
    facts = [F.min("core").alias("lo"), F.max("core").alias("hi"), F.min("comp").alias("first"), F.max("comp").alias("last")]
    for r in rows.groupBy("cell").agg(*facts).collect():
        low[r.cell], high[r.cell] = r.lo, r.hi
        one[r.cell] = r.first if r.first == r.last else None
    upper = np.maximum(cells.upper(), np.maximum(high[:, None], high[None, :]))
    lower = np.maximum(cells.lower(), np.maximum(low[:, None], low[None, :]))
    used = np.flatnonzero(cells.rows)
    step = np.full_like(upper, np.inf)
    reached = [int(used[0])]
    best, source = upper[used[0]].copy(), np.full(len(upper), used[0])
    open_ = set(int(i) for i in used[1:])
    while open_:
        new = min(open_, key=lambda i: best[i])
        open_.discard(new)
        longest = np.maximum(step[source[new], reached], best[new])
        longest[np.array(reached) == source[new]] = best[new]
        step[new, reached] = longest
        step[reached, new] = longest
        reached.append(new)
        closer = upper[new] < best
        best = np.where(closer, upper[new], best)
        source = np.where(closer, new, source)
    wanted = lower <= step * (1 + 1e-9) + 1e-9
    np.fill_diagonal(wanted, True)
    for name in {c for c in one if c is not None}:
        pure = np.array([c == name for c in one])
        wanted[np.ix_(pure, pure)] = False
    return wanted


def _meeting_tree(pairs, reach=None):
    """Spanning forest of the edges between all given pairs of blocks."""
    import pandas as pd

    found, held = [np.empty((3, 0))], 0
    for a, b in pairs:
        a.about = reach
        found.append(_pair_tree(a, b))
        held += found[-1].shape[1]
        if held > TAIL_EDGES:
            found = [_forest(np.concatenate(found, axis=1))]
            held = found[0].shape[1]
    a, b, weight = _forest(np.concatenate(found, axis=1))
    return pd.DataFrame({"a": a.view("int64"), "b": b.view("int64"), "weight": weight})


def _edges(a, b, weight) -> np.ndarray:
    """Edges as one array; the ids keep their bits."""
    return np.stack([a.astype("int64").view("float64"), b.astype("int64").view("float64"), weight])


def _pointed_at(up):
    """Follow pointers to their end, where two that point at each other end at the smaller."""
    at = np.arange(len(up))
    up = np.where((up[up] == at) & (at < up), at, up)
    while True:
        further = up[up]
        if (further == up).all():
            return up
        up = further


def _lightest_edges(n: int, x, y, weight=None, bound=None):
    """(chosen edges, component of each of ``n`` nodes) of the forest of edges (x, y) that come by weight.

    With ``bound`` for each node only edges lighter than the bounds of a whole component are chosen for it.
    """
    comp, chosen, open_ = np.arange(n), [np.empty(0, "int64")], np.arange(len(x))
    bound = None if bound is None else bound.copy()
    while True:
        cx, cy = comp[x[open_]], comp[y[open_]]
        out = cx != cy
        open_, cx, cy = open_[out], cx[out], cy[out]
        if not len(open_):
            return np.concatenate(chosen), comp
        best = np.full(n, len(x))
        np.minimum.at(best, cx, open_)
        np.minimum.at(best, cy, open_)
        at = np.flatnonzero(best < len(x))
        if bound is not None:
            at = at[weight[best[at]] < bound[at]]
            if not len(at):
                return np.concatenate(chosen), comp
        edge = best[at]
        chosen.append(np.unique(edge))
        up = np.arange(n)
        up[at] = np.where(comp[x[edge]] == at, comp[y[edge]], comp[x[edge]])
        up = _pointed_at(up)
        comp = up[comp]
        if bound is not None:
            np.minimum.at(bound, up, bound.copy())


def _forest(edges: np.ndarray) -> np.ndarray:
    """The minimum spanning forest of edges, ties by (weight, a, b)."""
    a, b, weight = edges[0].view("int64"), edges[1].view("int64"), edges[2]
    order = np.lexsort((b, a, weight))
    ids, ends = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    chosen, _ = _lightest_edges(len(ids), ends[:len(a)], ends[len(a):])
    return edges[:, order[np.sort(chosen)]]


@dataclass
class _Side:
    """Some rows of a block."""

    ids: np.ndarray
    vectors: np.ndarray
    core: np.ndarray
    comp: np.ndarray
    bound: np.ndarray

    def where(self, keep) -> _Side:
        return self if keep.all() else _Side(*(x[keep] for x in (self.ids, self.vectors, self.core, self.comp, self.bound)))


def _side(block: blocks.Block) -> _Side:
    core, comp, bound = (np.ascontiguousarray(x) for x in block.extra.reshape(-1, 3).T)
    return _Side(block.ids, block.vectors, core.view("float64"), comp, bound.view("float64"))


def _pair_tree(a: blocks.Block, b: blocks.Block) -> np.ndarray:
    """Edges of one block, or between two, that join the components of their rows to a spanning forest.

    Rows of the component that most rows are in are not compared with each other. If the components are few, each pair
    of them is looked at by itself, and only the rows that can have an edge as light as the way that is known.
    """
    left, right = _side(a), _side(b)
    if a.about is not None:
        return _between_few(left, right, a.number == b.number, *a.about)
    if a.number == b.number:
        return _joining(left, left)
    names, count = np.unique(np.concatenate([left.comp, right.comp]), return_counts=True)
    large = names[count.argmax()]
    in_a, in_b = left.comp == large, right.comp == large
    if not in_a.any() or not in_b.any():
        return _joining(left, right)
    return np.concatenate([_joining(left.where(~in_a), right), _joining(left.where(in_a), right.where(~in_b))], axis=1)


def _between_few(a: _Side, b: _Side, same: bool, names: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = [np.empty((3, 0))]
    for x in np.unique(a.comp):
        for y in np.unique(b.comp):
            if x == y or (same and x > y):
                continue
            i, j = np.searchsorted(names, x), np.searchsorted(names, y)
            known = i < len(names) and j < len(names) and names[i] == x and names[j] == y
            top = table[i, j] if known else np.inf
            left, right = (side.where((side.comp == c) & (np.maximum(side.core, side.bound) <= top + 2 / WEIGHT_UNIT))
                           for side, c in ((a, x), (b, y)))
            if len(left.ids) and len(right.ids):
                found.append(_lightest_between(left, right, top))
    return np.concatenate(found, axis=1)


def _joining(a: _Side, b: _Side) -> np.ndarray:
    """Spanning forest, over the components of the rows, of the edges between two sides, or of one with itself.

    In each round every row finds its lightest edge to another component, and every component takes the
    lightest of these; edges inside a component are struck out. Ids ascend in a block, so the first of
    equally light edges of a row is the one with the smallest ids.
    """
    same = a is b
    names, comp = np.unique(np.concatenate([a.comp] if same else [a.comp, b.comp]), return_inverse=True)
    if not len(a.ids) or not len(b.ids) or len(names) < 2:
        return np.empty((3, 0))
    comp = comp.astype("int32")
    shared = same or len(np.intersect1d(a.comp, b.comp)) > 0
    if len(names) == 2 and not shared:
        return _lightest_between(a, b)
    middle = a.vectors.mean(axis=0)
    w = np.concatenate([t for _, t in blocks.distance_tiles(a.vectors - middle, b.vectors - middle)])
    np.maximum(w, a.core[:, None], out=w)
    np.maximum(w, b.core[None, :], out=w)
    w *= WEIGHT_UNIT
    np.rint(w, out=w)
    n, m = w.shape
    if same:
        ids, sides = a.ids, [(w, slice(0, n), slice(0, n))]
    else:
        ids = np.concatenate([a.ids, b.ids])
        sides = [(w, slice(0, n), slice(n, n + m)), (np.ascontiguousarray(w.T), slice(n, n + m), slice(0, n))]
    found = [np.empty((3, 0))]
    while True:
        if shared:
            for table, mine, theirs in sides:
                np.putmask(table, comp[mine, None] == comp[None, theirs], np.inf)
        shared = True
        other, best = np.empty(len(ids), "int64"), np.empty(len(ids))
        for table, mine, theirs in sides:
            at = table.argmin(axis=1)
            other[mine], best[mine] = at + theirs.start, table[np.arange(len(at)), at]
        row = np.flatnonzero(np.isfinite(best))
        if not len(row):
            break
        other, best = other[row], best[row]
        low, high = np.minimum(ids[row], ids[other]), np.maximum(ids[row], ids[other])
        order = np.lexsort((high, low, best, comp[row]))
        first = order[np.r_[True, comp[row[order[1:]]] != comp[row[order[:-1]]]]]
        up = np.arange(len(ids))
        up[comp[row[first]]] = comp[other[first]]
        to = _pointed_at(up)
        # of two components that took the same edge, the root does not count it again
        new = first[to[comp[row[first]]] != comp[row[first]]]
        found.append(_edges(low[new], high[new], best[new] / WEIGHT_UNIT))
        comp = to[comp].astype("int32")
        if (comp == comp[0]).all():
            break
    return np.concatenate(found, axis=1)


def _lightest_between(a: _Side, b: _Side, limit: float = np.inf) -> np.ndarray:
    """The lightest edge up to ``limit`` between two components, one on each side, ties by (weight, a, b).

    Bounds of the distances come from matrix products; only those that may be the least are computed exactly.
    """
    middle = a.vectors.mean(axis=0)
    best = None
    for start, low, _ in blocks.squares_below(a.vectors - middle, b.vectors - middle):
        i, j = np.divmod(low.argmin(), low.shape[1])
        least = blocks.exact_distances(a.vectors, b.vectors, np.array([start + i]), np.array([j]))[0]
        limit = np.fmin(limit, max(least, a.core[start + i], b.core[j]))
        top = (limit + 2 / WEIGHT_UNIT) * (1 + 1e-12)
        i, j = np.nonzero(low <= blocks.at_least(np.array(top * top), low))
        i += start
        near = (a.core[i] <= top) & (b.core[j] <= top)
        i, j = i[near], j[near]
        weight = np.maximum(blocks.exact_distances(a.vectors, b.vectors, i, j), np.maximum(a.core[i], b.core[j]))
        unit, low_id, high_id = np.rint(weight * WEIGHT_UNIT), np.minimum(a.ids[i], b.ids[j]), np.maximum(a.ids[i], b.ids[j])
        for e in np.lexsort((high_id, low_id, unit))[:1]:
            one = (unit[e], int(low_id[e]), int(high_id[e]))
            best = one if best is None or one < best else best
    if best is None:
        return np.empty((3, 0))
    return _edges(np.array([best[1]]), np.array([best[2]]), np.array([best[0]]) / WEIGHT_UNIT)


def spanning_forest(edges: DataFrame, tail_edges: int | None = None) -> DataFrame:
    """Minimum spanning forest of a table of edges by rounds of joining components.

    Each round every component takes its lightest outgoing edge, ties by (weight, a, b),
    so that no cycle can arise, and joined components become one.
    """
    return _rounds(edges, tail_edges)[0]


def components(edges: DataFrame, tail_edges: int | None = None) -> DataFrame:
    """(vec_id, root) of every row that has an edge; the root is one row per component."""
    weighted = edges.select("a", "b", F.lit(0.0).alias("weight"))
    return _rounds(weighted, tail_edges)[1]


def _rounds(edges: DataFrame, tail_edges: int | None, bounds: DataFrame | None = None):
    """(forest, labels). With ``bounds`` (vec_id, bound) a component takes an edge only if that is lighter than the
    bounds of all its rows, and the rounds end when none does."""
    tail_edges = TAIL_EDGES if tail_edges is None else tail_edges
    ends = edges.select(F.explode(F.array("a", "b")).alias("vec_id")).distinct()
    labels = cut(ends.withColumn("root", F.col("vec_id")))
    open_ = cut(
        edges.groupBy("a", "b").agg(F.min("weight").alias("weight")).where("a <> b")
        .withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))
    )
    chosen = []
    if bounds is not None:
        bounds = bounds.select(F.col("vec_id").alias("comp"), "bound")
    while True:
        n = open_.count()
        if n == 0:
            break
        if n <= tail_edges:
            left = open_ if bounds is None else open_.unionByName(bounds.select(
                *[F.col("comp").alias(c) for c in ("a", "b", "ca", "cb")], F.col("bound").alias("weight")))
            solved = cut(left.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(
                _tail, "a long, b long, weight double, comp long, root long"))
            chosen.append(solved.where("a IS NOT NULL").select("a", "b", "weight"))
            roots = solved.where("comp IS NOT NULL").select("comp", "root")
            labels = _relabel(labels, roots, 2 * n)
            break
        outgoing = open_.select(
            F.explode(F.array(
                F.struct(F.col("ca").alias("comp"), F.col("cb").alias("other")),
                F.struct(F.col("cb").alias("comp"), F.col("ca").alias("other")),
            )).alias("e"), "weight", "a", "b",
        )
        lightest = F.min(F.struct("weight", "a", "b", "e.other"))
        best = outgoing.groupBy("e.comp").agg(lightest.alias("m")).select("comp", "m.*")
        if bounds is not None:
            best = best.join(bounds, "comp").where("weight < bound").drop("bound")
        best = cut(best)
        chosen.append(best.select("a", "b", "weight").distinct())
        back = best.select(F.col("comp").alias("other"), F.col("other").alias("back"))
        is_root = (F.col("back") == F.col("comp")) & (F.col("comp") < F.col("other"))
        n_best = best.count()
        if n_best == 0:
            break
        roots = lookup_join(best, back, ["other"], rows=n_best).select(
            "comp", F.when(is_root, F.col("comp")).otherwise(F.col("other")).alias("root")
        )
        roots = _shortcut(cut(roots), n_best)
        labels = _relabel(labels, roots, n_best)
        if bounds is not None:
            moved = lookup_join(bounds, roots, ["comp"], rows=n_best)
            bounds = cut(moved.groupBy(F.coalesce("root", "comp").alias("comp")).agg(F.min("bound").alias("bound")))
        one = roots.select(F.col("comp").alias("ca"), F.col("root").alias("ra"))
        other = roots.select(F.col("comp").alias("cb"), F.col("root").alias("rb"))
        open_ = lookup_join(open_, one, ["ca"], rows=n_best)
        open_ = lookup_join(open_, other, ["cb"], rows=n_best)
        ca, cb = F.coalesce("ra", "ca"), F.coalesce("rb", "cb")
        open_ = open_.select("a", "b", "weight", F.least(ca, cb).alias("ca"), F.greatest(ca, cb).alias("cb"))
        lightest = F.min(F.struct("weight", "a", "b")).alias("m")
        open_ = cut(open_.where("ca <> cb").groupBy("ca", "cb").agg(lightest).select("m.*", "ca", "cb"))
    forest = edges.sparkSession.createDataFrame([], TREE_SCHEMA)
    for part in chosen:
        forest = forest.unionByName(part)
    return forest, labels


def _shortcut(roots: DataFrame, n: int) -> DataFrame:
    """Follow pointers until every component points at its root."""
    while True:
        above = roots.select(F.col("comp").alias("root"), F.col("root").alias("above"))
        nearer = cut(lookup_join(roots, above, ["root"], rows=n).select(
            "comp", F.coalesce("above", "root").alias("root"),
            (F.coalesce("above", "root") != F.col("root")).alias("moved"),
        ))
        roots = nearer.select("comp", "root")
        if nearer.where("moved").isEmpty():
            return roots


def _relabel(labels: DataFrame, roots: DataFrame, n: int) -> DataFrame:
    moved = roots.select(F.col("comp").alias("root"), F.col("root").alias("_new"))
    joined = lookup_join(labels, moved, ["root"], rows=n)
    return cut(joined.select("vec_id", F.coalesce("_new", "root").alias("root")))


def _tail(frame):
    """Forest and roots of a bounded remainder."""
    import pandas as pd

    # an edge of a component with itself tells the bound of that component
    own = frame["ca"] == frame["cb"]
    bounds, frame = frame[own], frame[~own].sort_values(["weight", "a", "b"])
    ids, ends = np.unique(np.concatenate([frame["ca"].to_numpy("int64"), frame["cb"].to_numpy("int64")]), return_inverse=True)
    limit = None
    if len(bounds):
        limit = np.full(len(ids), -np.inf)
        at = np.searchsorted(ids, bounds["ca"].to_numpy("int64"))
        known = ids[np.minimum(at, len(ids) - 1)] == bounds["ca"].to_numpy("int64")
        limit[at[known]] = bounds["weight"].to_numpy("float64")[known]
    chosen, comp = _lightest_edges(len(ids), ends[:len(frame)], ends[len(frame):], frame["weight"].to_numpy("float64"), limit)
    kept = frame.iloc[np.sort(chosen)]
    edges = pd.DataFrame({"a": kept["a"].astype("Int64"), "b": kept["b"].astype("Int64"), "weight": kept["weight"].astype("Float64")})
    roots = pd.DataFrame({"comp": pd.array(ids, "Int64"), "root": pd.array(ids[comp], "Int64")})
    return pd.concat([edges, roots], ignore_index=True)[["a", "b", "weight", "comp", "root"]]
