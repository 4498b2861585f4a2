"""Pairwise work on vectors, block against block.

Rows are cut into blocks of bounded size, and blocks into groups of bounded size. A job that
needs distances between rows lets two blocks meet in a task, works on them with numpy and
returns a small summary, so no distance is ever a row of a table. A block travels once for each
group that wants it, not once for each block: either a task owns a group and sees the other
blocks one after the other (``by_owner``), or two groups meet in it (``by_meeting``).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame, functions as F

from postlens.session import cut

BLOCK_ROWS = 2048
MAX_CELLS = 2048
TILE_ROWS = 256
#: Blocks that one group may have. As long as they have fewer, there is one owner of blocks for each core, and
#: a few meetings of groups for each core.
GROUP_BLOCKS = 64
MEETINGS_A_CORE = 4
#: Bytes of vectors that a group may have, so that wide vectors make smaller groups.
GROUP_BYTES = 1 << 28


@dataclass
class Block:
    ids: np.ndarray
    vectors: np.ndarray
    extra: np.ndarray
    number: int = 0
    cell: int = 0
    #: What a job tells the function that works on its blocks.
    about: object = None


def distance_tiles(a: np.ndarray, b: np.ndarray):
    """(start, distances of some rows of ``a`` to all of ``b``).

    Matrix products give the squares; where they cancel, for rows that are close compared
    with their length, the difference is taken component by component instead.
    """
    sa, sb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    for start in range(0, len(a), TILE_ROWS):
        part = a[start:start + TILE_ROWS]
        scale = sa[start:start + TILE_ROWS, None] + sb[None, :]
        squares = scale - 2.0 * (part @ b.T)
        rows, cols = np.nonzero(squares < 1e-2 * scale)
        for low in range(0, len(rows), 65536):
            i, j = rows[low:low + 65536], cols[low:low + 65536]
            diff = part[i] - b[j]
            squares[i, j] = np.einsum("ij,ij->i", diff, diff)
        yield start, np.sqrt(np.maximum(squares, 0.0))


def squares_below(a: np.ndarray, b: np.ndarray):
    """(start, lower bounds, slack) of the squared distances of some rows of ``a`` to all of ``b``.

    The true square lies between the bound and the bound plus twice the slack of its row and column, (per row,
    per column), whatever cancels in the matrix product. Numbers of four bytes do for a bound, unless they would overflow.
    """
    sa, sb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    largest = max(sa.max(initial=0.0), sb.max(initial=0.0))
    kind, tiny = ("float32", 1e-36) if largest < 1e30 else ("float64", 0.0)
    eps = 4 * (a.shape[1] + 8) * np.finfo(kind).eps
    # the squares of both lengths are two more components, so that one product gives the whole bound
    left = np.concatenate([-2.0 * a, ((1 - eps) * sa - tiny)[:, None], np.ones((len(a), 1))], axis=1).astype(kind)
    right = np.concatenate([b, np.ones((len(b), 1)), ((1 - eps) * sb - tiny)[:, None]], axis=1).T.astype(kind)
    for start in range(0, len(a), TILE_ROWS):
        yield start, left[start:start + TILE_ROWS] @ right, (eps * sa[start:start + TILE_ROWS] + 2 * tiny, eps * sb + 2 * tiny)


def at_least(x: np.ndarray, like: np.ndarray) -> np.ndarray:
    """``x`` in the number format of ``like``, not smaller than it was."""
    with np.errstate(over="ignore"):
        return x if like.dtype == x.dtype else np.nextafter(x.astype(like.dtype), np.array(np.inf, like.dtype))


def exact_distances(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distance of row i of ``a`` to row j of ``b`` for each pair (i, j), component by component."""
    out = np.empty(len(i))
    for low in range(0, len(i), 65536):
        diff = a[i[low:low + 65536]] - b[j[low:low + 65536]]
        out[low:low + 65536] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


@dataclass
class Cells:
    """What is known about each cell; at most MAX_CELLS of them, so arrays on the driver."""

    pivots: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    def gaps(self) -> np.ndarray:
        none = np.zeros((0, len(self.pivots)))
        return np.concatenate([none, *(tile for _, tile in distance_tiles(self.pivots, self.pivots))])

    def lower(self) -> np.ndarray:
        """Smallest distance that rows of two cells can have."""
        return self.gaps() - self.radius[:, None] - self.radius[None, :]

    def upper(self) -> np.ndarray:
        """Largest distance that rows of two cells can have."""
        return self.gaps() + self.radius[:, None] + self.radius[None, :]


def split(df: DataFrame, block_rows: int | None = None, max_cells: int = MAX_CELLS):
    """Add ``cell`` and ``block``; near rows share a cell, big cells become several blocks.

    Cells belong to pivots, a hash-chosen sample of at most ``max_cells`` rows. Returns the
    rows, cut because they are used several times, and the cells.
    """
    block_rows = block_rows or BLOCK_ROWS
    n = df.count()
    n_cells = max(1, min(max_cells, -(-n // block_rows)))
    chosen = df.select("vec_id", "z").orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_cells).collect()
    pivots = np.array([r.z for r in chosen], dtype="float64").reshape(len(chosen), -1 if chosen else 0)
    schema = df.withColumn("cell", F.lit(0)).withColumn("r", F.lit(0.0)).schema

    def assign(frames):
        for frame in frames:
            if not len(frame):
                continue
            z = np.array(frame["z"].tolist(), dtype="float64")
            cell = np.empty(len(z), dtype="int32")
            r = np.empty(len(z))
            for start, tile in distance_tiles(z, pivots):
                best = tile.argmin(axis=1)
                cell[start:start + len(tile)] = best
                r[start:start + len(tile)] = tile[np.arange(len(tile)), best]
            yield frame.assign(cell=cell, r=r)

    assigned = cut(df.mapInPandas(assign, schema))
    radius, rows = np.zeros(len(pivots)), np.zeros(len(pivots), "int64")
    for row in assigned.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("r")).collect():
        radius[row.cell], rows[row.cell] = row.r, row.n
    parts = -(-rows // block_rows)
    first = np.cumsum(parts) - parts
    cells = Cells(pivots, radius, rows, first, parts)
    numbers = assigned.sparkSession.createDataFrame(
        [(i, int(first[i]), int(parts[i])) for i in range(len(parts)) if parts[i]],
        "cell int, first long, parts long",
    )
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    numbered = assigned.join(F.broadcast(numbers), "cell").withColumn("block", F.col("first") + part)
    return numbered.drop("first", "parts", "r"), cells


def pack(df: DataFrame, extra: str | None = None) -> DataFrame:
    """One row per block: (block, cell, ids, vectors, extra, kind, n, dim) with packed numbers.

    ``extra`` is a number or an array of whole numbers of the same length in each row.
    """
    return cut(_packed(df, extra, ["block"]))


def _packed(df: DataFrame, extra: str | None, keys: list[str]) -> DataFrame:
    listed = extra is not None and df.schema[extra].dataType.typeName() == "array"
    whole = extra is None or listed or df.schema[extra].dataType.typeName() in ("integer", "long")
    kind = "int64" if whole else "float64"

    def one(frame):
        import pandas as pd

        frame = frame.sort_values("vec_id")
        z = np.array(frame["z"].tolist(), dtype="float64")
        if listed:
            extra_values = np.array(frame[extra].tolist(), kind)
        else:
            extra_values = frame[extra].to_numpy(kind) if extra else np.zeros(len(frame), "int64")
        return pd.DataFrame([{
            "block": int(frame["block"].iloc[0]), "cell": int(frame["cell"].iloc[0]),
            "ids": frame["vec_id"].to_numpy("int64").tobytes(), "vectors": _narrow(z).tobytes(),
            "extra": extra_values.tobytes(), "kind": kind, "n": len(frame), "dim": z.shape[1],
        }])

    schema = "block long, cell int, ids binary, vectors binary, extra binary, kind string, n long, dim long"
    return df.groupBy(*keys).applyInPandas(one, schema)


def _narrow(z: np.ndarray) -> np.ndarray:
    """The same numbers in four bytes each, if all of them have a four-byte form."""
    with np.errstate(over="ignore", invalid="ignore"):
        short = z.astype("float32")
    return short if np.array_equal(short, z) else z


def unpack(row) -> Block:
    n, dim = int(row.n), int(row.dim)
    kind = "float32" if len(row.vectors) < 8 * n * dim else "float64"
    return Block(
        np.frombuffer(row.ids, "int64"),
        np.frombuffer(row.vectors, kind).reshape(n, dim).astype("float64"),
        np.frombuffer(row.extra, row.kind), int(row.block), int(row.cell),
    )


# -- groups of blocks ---------------------------------------------------------------------------

def cells_in_space(pivots: np.ndarray) -> np.ndarray:
    """Cells in an order in which near ones mostly follow each other: halved along their widest component."""
    order, todo = [], [np.arange(len(pivots))]
    while todo:
        part = todo.pop()
        if len(part) < 2:
            order.extend(int(i) for i in part)
            continue
        at = pivots[part]
        by = part[np.argsort(at[:, np.ptp(at, axis=0).argmax()] if at.shape[1] else part, kind="stable")]
        todo += [by[len(by) // 2:], by[:len(by) // 2]]
    return np.array(order, "int64")


def groups_of_blocks(cells: Cells, n_groups: int, most_blocks: int = GROUP_BLOCKS):
    """(group of each block, cell of each block): groups of equally many blocks, near ones together."""
    total = int(cells.parts.sum())
    cell = np.repeat(np.arange(len(cells.parts)), cells.parts)
    in_space = cells_in_space(cells.pivots)
    order = np.concatenate([np.arange(cells.first[c], cells.first[c] + cells.parts[c]) for c in in_space] or [[]]).astype("int64")
    size = max(1, min(max(1, most_blocks), -(-total // max(1, n_groups))))
    group = np.empty(total, "int64")
    group[order] = np.arange(total) // size
    return group, cell


def cores_of(spark) -> int:
    return max(spark.sparkContext.defaultParallelism, 2)


def _sent(df: DataFrame, extra: str | None, keys: list[str], receivers, n_receivers: int) -> DataFrame:
    """Packed blocks, once for each receiver, dealt and sorted by it. ``receivers(block, cell, extra)`` lists
    (receiver, order) of a block."""
    packed = _packed(df, extra, keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields) + ", to array<struct<receiver: int, near: double>>"

    def address(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("receiver", pa.int32()), ("near", pa.float64())]))
        for batch in batches:
            to = []
            for block, cell, value, dtype in zip(*(batch.column(c).to_pylist() for c in ("block", "cell", "extra", "kind"))):
                at, near = receivers(block, cell, np.frombuffer(value, dtype))
                to.append([{"receiver": int(r), "near": float(x)} for r, x in zip(at, near)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, kind)], names=[*batch.schema.names, "to"])

    listed = packed.mapInArrow(address, schema)
    each = listed.select(F.explode("to").alias("e"), *packed.columns).select("e.receiver", "e.near", *packed.columns)
    return each.repartitionById(n_receivers, F.col("receiver")).sortWithinPartitions("receiver", "near", "block")


class _Row:
    """A packed block as it arrives in a task."""

    def __init__(self, names, values):
        self.__dict__.update(zip(names, values))


def _received(batches):
    """(receiver, rows) in the order of a task's partition, without holding more than a batch."""
    rows = (
        _Row(batch.schema.names, values) for batch in batches
        for values in zip(*(column.to_pylist() for column in batch.columns))
    )
    return groupby(rows, key=lambda r: r.receiver)


def by_owner(
    df: DataFrame, cells: Cells, wanted: np.ndarray | None, work, schema: str, extra: str | None = None,
    most_blocks: int = GROUP_BLOCKS, asking: bool = False,
) -> DataFrame:
    """Run ``work(own blocks, other blocks) -> frames`` for each group of blocks of (vec_id, z, cell, block).

    There is one group for each core until groups have ``most_blocks``, so a block travels at most once for each core.
    The own blocks are a list; the others come one after the other, those of the nearest cells first, and are
    not held. Own blocks have to be compared with each other by ``work``. With ``asking`` rows whose ``extra``
    is 1 are owned only, and those with 0 are others only, of their own group too.
    """
    most_blocks = min(most_blocks, max(1, GROUP_BYTES // (8 * BLOCK_ROWS * max(1, cells.pivots.shape[1]))))
    group, cell_of = groups_of_blocks(cells, cores_of(df.sparkSession), most_blocks)
    n = int(group.max()) + 1 if len(group) else 1
    # how far each group is from each cell, and whether it wants it
    far = np.full((n, len(cells.parts)), np.inf)
    wants = np.zeros((n, len(cells.parts)), bool)
    start = 0
    for _, tile in distance_tiles(cells.pivots, cells.pivots):
        for at in range(len(tile)):
            for g in np.unique(group[cell_of == start + at]):
                far[g] = np.minimum(far[g], tile[at])
                wants[g] |= True if wanted is None else wanted[start + at]
        start += len(tile)

    def receivers(block, cell, value):
        own = int(group[block])
        if asking and value[0] == 1:
            return [own], [-1.0]
        others = np.flatnonzero(wants[:, cell])
        near = far[others, cell]
        if asking:
            return others, near
        others, near = others[others != own], near[others != own]
        return [own, *others], [-1.0, *near]

    sent = _sent(df, extra, ["block", extra] if asking else ["block"], receivers, n)

    def run(batches):
        import pyarrow as pa

        for _, rows in _received(batches):
            own, first = [], None
            for row in rows:
                if row.near >= 0:
                    first = row
                    break
                own.append(unpack(row))
            if own:
                others = (unpack(r) for part in ([first] if first is not None else [], rows) for r in part)
                for frame in work(own, others):
                    yield from pa.Table.from_pandas(frame, preserve_index=False).to_batches(max_chunksize=65536)

    return sent.mapInArrow(run, schema)


def by_meeting(df: DataFrame, cells: Cells, wanted: np.ndarray, work, schema: str, extra: str | None = None) -> DataFrame:
    """Run ``work(list of pairs of Blocks) -> frame`` for each pair of groups that has blocks of wanted cells.

    There are a few times as many pairs of groups as cores, so a block travels about the root of that many
    times. A pair of equal blocks comes as the same object twice.
    """
    cores = cores_of(df.sparkSession)
    group, cell_of = groups_of_blocks(cells, int(np.ceil(np.sqrt(2 * MEETINGS_A_CORE * cores))))
    n = int(group.max()) + 1 if len(group) else 1
    # which groups want a cell, and which cells a group has
    wants = np.zeros((n, len(cells.parts)), bool)
    for g in range(n):
        mine = np.unique(cell_of[group == g])
        wants[g] = wanted[mine].any(axis=0) if len(mine) else False
    meets = np.zeros((n, n), bool)
    for g in range(n):
        meets[g] = wants[:, np.unique(cell_of[group == g])].any(axis=1)
    meets |= meets.T
    at, number = np.full((n, n), -1), 0
    for g, h in zip(*np.nonzero(np.triu(meets))):
        at[g, h] = at[h, g] = number
        number += 1

    def receivers(block, cell, value):
        g = int(group[block])
        others = np.flatnonzero(meets[g] & (wants[:, cell] | (np.arange(n) == g)))
        return at[g, others], np.zeros(len(others))

    sent = _sent(df, extra, ["block"], receivers, max(1, number))

    def run(batches):
        import pyarrow as pa

        for _, rows in _received(batches):
            found = sorted((unpack(r) for r in rows), key=lambda b: b.number)
            ends = sorted({int(group[b.number]) for b in found})
            left = [b for b in found if group[b.number] == ends[0]]
            right = [b for b in found if group[b.number] == ends[-1]]
            met = [(a, b) if a.number <= b.number else (b, a) for a in left for b in right
                   if wanted[a.cell, b.cell] and (len(ends) > 1 or a.number <= b.number)]
            frame = work(met)
            if len(frame):
                yield from pa.Table.from_pandas(frame, preserve_index=False).to_batches(max_chunksize=65536)

    return sent.mapInArrow(run, schema)


def pairs(packed: DataFrame, cells: Cells, wanted: np.ndarray | None = None) -> DataFrame:
    """(a, b) with a <= b: block numbers only, one row per pair of blocks that has to meet.

    ``wanted`` is a symmetric table of the pairs of cells that matter; None means all.
    """
    import pandas as pd

    first, parts = cells.first, cells.parts
    total = int(parts.sum())

    def emit(frames):
        for frame in frames:
            for block, cell in zip(frame["block"], frame["cell"]):
                if wanted is None:
                    others = np.arange(block, total)
                else:
                    near = [np.arange(first[j], first[j] + parts[j]) for j in np.flatnonzero(wanted[cell])]
                    others = np.concatenate(near) if near else np.empty(0, "int64")
                    others = others[others >= block]
                yield pd.DataFrame({"a": np.full(len(others), block, "int64"), "b": others.astype("int64")})

    return packed.select("block", "cell").mapInPandas(emit, "a long, b long").join(
        packed.select(F.col("block").alias("b")), "b", "left_semi"
    ).select("a", "b")


def map_pairs(packed: DataFrame, pair_rows: DataFrame, function, schema: str) -> DataFrame:
    """Run ``function(Block a, Block b, same) -> frame`` for each pair of blocks."""
    sides = pair_rows.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    parts = max(
        packed.sparkSession.sparkContext.defaultParallelism,
        int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    rows = sides.join(packed, "block").repartition(parts, "a", "b")

    def meet(frame):
        a, b = int(frame["a"].iloc[0]), int(frame["b"].iloc[0])
        found = {int(r.block): unpack(r) for r in frame.itertuples(index=False)}
        return function(found[a], found[b], a == b)

    return rows.groupBy("a", "b").applyInPandas(meet, schema)
