"""Near duplicates by weighted MinHash with thrown darts, banded joins and exact checks.

A document is the multiset of its runs of five words, lower-cased, without punctuation. Each
unit of an element's weight is a cell that throws a Poisson stream of darts by rank; each dart
hits one of k coordinates, and a coordinate keeps its earliest dart. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity. Only as many darts are
looked at as a document needs to fill its coordinates, so long documents cost little per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from postlens.llm import words as W
from postlens.llm.frames import fresh, written
from postlens.operators.joins import lookup_join

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 48
ROWS = 8
#: Bounds of a block of texts that meets another in one task: rows, and units of all rows.
BLOCK_ROWS = 2048
BLOCK_UNITS = 1 << 20
UNITS_AT_ONCE = 1024
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = np.uint64(0xD1B54A32D192ED03)
_TURN = np.uint64(0x8CB92BA72F3D8DD7)


def elements(words: W.Words, size: int = SHINGLE):
    """(row, element, weight) of the runs of words in a block, sorted by row and element."""
    _, doc, h = W.windows(words, size)
    key = np.sort((doc.astype(np.uint64) << np.uint64(52)) | (h >> np.uint64(12)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.diff(np.append(first, len(key))).astype(np.float64)
    key = key[first]
    return (key >> np.uint64(52)).astype(np.int64), key & np.uint64((1 << 52) - 1), weight


def dart_signatures(doc, element, weight, rows: int, k: int) -> np.ndarray:
    """k coordinates for each of ``rows`` weighted sets; rows without weight stay empty.

    Weights may be any positive numbers: in the last, partly used cell of an element only the
    darts that fall below the weight count.
    """
    total = np.bincount(doc, weight, rows)
    cells = np.ceil(weight).astype(np.int64)
    of = np.repeat(np.arange(len(doc)), cells)
    level = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
    room = np.minimum(weight[of] - level, 1.0)
    row = doc[of]
    limit = np.zeros(rows)
    np.divide(k * (np.log(k) + 3.0), total, out=limit, where=total > 0)
    signature = np.full(rows * k, _EMPTY, np.uint64)
    with np.errstate(over="ignore"):
        cell = W.mix(element[of] * np.uint64(W.MULTIPLIER) + level.astype(np.uint64))
        todo = np.arange(len(cell))
        while len(todo):
            alive, rank, throw = todo, np.zeros(len(todo)), np.uint64(0)
            while len(alive):
                throw += np.uint64(1)
                x = W.mix(cell[alive] + throw * _STEP)
                rank = rank - np.log(((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53)
                near = rank <= limit[row[alive]]
                alive, rank, x = alive[near], rank[near], x[near]
                y = W.mix(x ^ _TURN)
                here = (y & np.uint64(0xFFFFFF)).astype(np.float64) * 2.0**-24 < room[alive]
                slot = row[alive] * k + ((y >> np.uint64(24)) % np.uint64(k)).astype(np.int64)
                dart = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (
                    W.mix(y) >> np.uint64(32))
                np.minimum.at(signature, slot[here], dart[here])
            lacking = (signature.reshape(rows, k) == _EMPTY).any(axis=1) & (total > 0)
            limit[lacking] *= 2
            todo = np.flatnonzero(lacking[row])
    return signature.reshape(rows, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(W.mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
        for j in range(rows):
            key = W.mix(key * np.uint64(W.MULTIPLIER) + parts[:, :, j])
    return key.view(np.int64)


def _sketcher(bands: int, rows: int, size: int):
    def run(batches):
        reader, plain = W.Reader(W.byte_classes()), W.Reader(W.byte_classes())
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                part = texts.slice(lo, hi - lo)
                w = reader.read(W.folded(part))
                node = reader.hashes(w.hash, w.first[:-1], w.first[1:])
                data, offsets = W.raw(part)
                exact = plain.hashes(data.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:])
                node = np.where(w.count > 0, node, W.mix(exact ^ _TURN)).view(np.int64)
                keys = band_keys(dart_signatures(*elements(w, size), w.rows, bands * rows), bands, rows)
                has = w.count > 0
                offsets = np.concatenate([[0], np.cumsum(has * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("row").slice(lo, hi - lo),
                     pa.array(node), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[has].ravel()))],
                    names=["doc_id", "row", "node", "keys"],
                )
    return run


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, row, node, keys): ``row`` is a hash of id and text, ``node`` one of the words
    (of the text itself if it has no word); texts of equal words share their node."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row")).mapInArrow(
        _sketcher(bands, rows, size), f"doc_id {kind}, row bigint, node bigint, keys array<bigint>"
    )


def _units(reader: W.Reader, column: pa.Array, size: int):
    """Each unit of weight as one number that carries its row, and the units of each row."""
    w = reader.read(W.folded(column))
    doc, element, weight = elements(w, size)
    n = weight.astype(np.int64)
    level = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc = np.repeat(doc, n)
    with np.errstate(over="ignore"):
        cell = W.mix(np.repeat(element, n) * np.uint64(W.MULTIPLIER) + level.astype(np.uint64))
    return (doc.astype(np.uint64) << np.uint64(52)) | (cell >> np.uint64(12)), np.bincount(doc, minlength=w.rows)


def _comparer(size: int):
    def run(batches):
        reader = W.Reader(W.byte_classes())
        for batch in batches:
            left, right = W.strings(batch.column("text_a")), W.strings(batch.column("text_b"))
            for lo, hi in W.blocks(left, W.BLOCK_BYTES // 2, 512):
                a, size_a = _units(reader, left.slice(lo, hi - lo), size)
                b, size_b = _units(reader, right.slice(lo, hi - lo), size)
                both = np.intersect1d(a, b)
                common = np.bincount((both >> np.uint64(52)).astype(np.int64), minlength=hi - lo)
                union = size_a + size_b - common
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in ("a", "b")] + [pa.array(common / np.maximum(union, 1))],
                    names=["a", "b", "j"])
    return run


def _lister(size: int):
    """Function of (node, text): the sorted units of each text."""
    def run(batches):
        reader = W.Reader(W.byte_classes())
        for batch in batches:
            texts = W.strings(batch.column("text"))
            for lo, hi in W.blocks(texts):
                units, counts = _units(reader, texts.slice(lo, hi - lo), size)
                units = np.sort(units) & np.uint64((1 << 52) - 1)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(units.view(np.int64)))],
                    names=["node", "units"])
    return run


def similar(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(a, b, j): the exact weighted Jaccard similarity of pairs of nodes."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").mapInArrow(_comparer(size), "a bigint, b bigint, j double")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each connected set, for the nodes in ``edges``, a < b.

    Each node with a smaller neighbour hangs on the smallest one. Only nodes that others hang on
    take part in the iteration, so a star of any size is one join.
    """
    parent = written(edges.groupBy("b").agg(F.min("a").alias("p")))
    leaders = written(edges.select("a").distinct())
    across = edges.join(parent, "b").where("a <> p").select(F.least("p", "a").alias("a"), F.greatest("p", "a").alias("b"))
    upward = parent.join(leaders.withColumnRenamed("a", "b"), "b", "left_semi").select(F.col("p").alias("a"), "b")
    core = written(across.union(upward).distinct().coalesce(_tasks(edges)))
    labels = _least_labels(core)
    hung = parent.join(labels.withColumnRenamed("node", "p"), "p", "left").select(
        F.col("b").alias("node"), F.coalesce("comp", "p").alias("comp"))
    tops = leaders.join(parent.withColumnRenamed("b", "a"), "a", "left_anti").withColumnRenamed("a", "node")
    tops = tops.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
    return written(hung.union(tops).coalesce(_tasks(edges)))


def _least_labels(edges: DataFrame) -> DataFrame:
    """Smallest reachable node by passing labels on and jumping along them."""
    sides = [edges.select("a", "b"), edges.select(F.col("b").alias("a"), F.col("a").alias("b")),
             edges.select("a", F.col("a").alias("b")), edges.select(F.col("b").alias("a"), "b")]
    both = written(sides[0].union(sides[1]).union(sides[2]).union(sides[3]).distinct().coalesce(_tasks(edges)))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
    before = None
    while True:
        # labels only ever fall, so their sum stands still when nothing changes
        labels = written(labels.coalesce(_tasks(edges)))
        total = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        roots = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        jumped = labels.join(roots, "comp").select(F.col("node").alias("b"), F.col("root").alias("comp"))
        labels = both.join(jumped, "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("comp"))


def extended(labels: DataFrame, new: DataFrame) -> DataFrame:
    """``labels`` after further edges (a, b): only edges between different sets are followed."""
    for side in ("a", "b"):
        named = labels.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
        new = new.join(named, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    bridges = new.where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
    bridges = written(bridges.coalesce(_tasks(new)))
    if bridges.isEmpty():
        return labels
    moved = components(bridges)
    known = labels.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    fresh_nodes = moved.join(labels.select("node"), "node", "left_anti").select("node", "comp")
    return written(known.select("node", F.coalesce("to", "comp").alias("comp")).union(fresh_nodes).coalesce(_tasks(new)))


def _tasks(df: DataFrame) -> int:
    """Tasks that write a table of an iteration: as many as the session has cores for, at least."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def _least_links(linked: np.ndarray, comp: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows of the matrix ``linked`` that join all components it joins, one less than
    there are components at most."""
    names, of = np.unique(comp, return_inverse=True)
    rows, columns = np.nonzero(linked)
    sides = np.concatenate([of[rows] * len(names) + of[columns], of[columns] * len(names) + of[rows]])
    pair, at = np.unique(sides, return_index=True)
    start = np.searchsorted(pair, np.arange(len(names) + 1) * len(names))
    at = at % max(len(rows), 1)
    found, seen = [], np.zeros(len(names), bool)
    for first in np.unique(pair // len(names)):
        stack = [] if seen[first] else [first]
        seen[first] = True
        while stack:
            here = stack.pop()
            span = slice(start[here], start[here + 1])
            other = pair[span] % len(names)
            new = ~seen[other]
            seen[other[new]] = True
            found += [(int(rows[k]), int(columns[k])) for k in at[span][new]]
            stack += other[new].tolist()
    return found


def _block_links(similarity: float):
    """Function of the rows (block, node, comp, units) of two blocks: links (a, b) between components."""
    def run(group: pa.Table) -> pa.Table:
        block = group.column("block").to_numpy()
        node, comp = group.column("node").to_numpy(), group.column("comp").to_numpy()
        units = group.column("units").combine_chunks()
        if isinstance(units, pa.ChunkedArray):
            units = pa.concat_arrays(units.chunks)
        n = np.diff(units.offsets.to_numpy()).astype(np.int64)
        _, unit, held = np.unique(units.flatten().to_numpy(), return_inverse=True, return_counts=True)
        keep = held[unit] > 1
        row, unit = np.repeat(np.arange(len(n)), n)[keep], (np.cumsum(held > 1) - 1)[unit[keep]]
        order = np.argsort(unit, kind="stable")
        row, unit = row[order], unit[order]
        one = np.flatnonzero(block == block.min())
        two = one if block.min() == block.max() else np.flatnonzero(block == block.max())
        common = np.zeros((len(one), len(two)), np.float32)
        for lo in range(0, int(unit[-1]) + 1 if len(unit) else 0, UNITS_AT_ONCE):
            span = slice(*np.searchsorted(unit, [lo, lo + UNITS_AT_ONCE]))
            has = np.zeros((len(n), UNITS_AT_ONCE), np.float32)
            has[row[span], unit[span] - lo] = 1
            common += has[one] @ has[two].T
        union = n[one][:, None] + n[two][None, :] - common
        linked = (common >= similarity * union) & (comp[one][:, None] != comp[two][None, :])
        square = np.zeros((len(n), len(n)), bool)
        square[np.ix_(one, two)] = linked
        found = np.array(_least_links(square, comp), np.int64).reshape(-1, 2)
        a, b = node[found[:, 0]], node[found[:, 1]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return run


def _blocks(groups: DataFrame, listed: DataFrame) -> DataFrame:
    """(leader, lo, hi, block, node, comp, units): every two blocks of each group, and each with
    itself. ``groups`` is (leader, node, comp), ``listed`` (node, units, n)."""
    sized = groups.join(listed.select("node", "n"), "node")
    held = sized.groupBy("leader").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    parts = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_UNITS)).alias("parts")
    placed = lookup_join(groups, held.select("leader", parts), ["leader"], "inner")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")))
    placed = placed.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    return placed.select(
        "leader", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "comp"
    ).join(listed.select("node", "units"), "node")


def _links(nodes: DataFrame, texts_of, similarity: float, size: int) -> DataFrame | None:
    """Component of every node that has a link; None if there is no shared bucket.

    Each bucket is led by the member that meets most others in all of its buckets: among copies
    of one text that is the text they were made from, or one close to it. Each node is compared
    with the best leader that it meets, so a large group of copies costs one comparison a copy.
    Members of buckets that still hold several components meet in the group of the bucket's
    leader. A group is cut into blocks of bounded size, two blocks meet in a task that compares
    their sets and returns no more links than it takes to join components. So every two texts
    that share a bucket were compared or are connected, and no pair that is no link becomes a row.
    """
    members = nodes.select("node", F.explode("keys").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(sizes, "key"))
    if shared.isEmpty():
        return None
    texts = written(texts_of(shared.select("node").distinct()))
    met = shared.groupBy("node").agg(F.sum("n").alias("met"))
    ranked = shared.select("key", "node").join(met, "node")
    place = F.struct("met", F.expr("-node").alias("order"), "node")
    leaders = ranked.groupBy("key").agg(F.max(place).alias("lead"))
    led = written(shared.select("key", "node").join(leaders, "key"))
    best = led.groupBy("node").agg(F.max("lead").alias("lead"))
    pairs = best.select("node", F.col("lead.node").alias("leader")).where("leader <> node").select(
        F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    tested = similar(pairs, texts, size).where(F.col("j") >= similarity).select("a", "b")
    labels = components(written(tested))
    now = led.join(labels, "node", "left").select(
        "key", F.col("lead.node").alias("leader"), "node", F.coalesce("comp", "node").alias("comp"))
    now = written(now)
    mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    groups = written(now.join(mixed, "key").select("leader", "node", "comp").distinct())
    if groups.isEmpty():
        return labels
    active = texts.join(groups.select("node").distinct(), "node", "left_semi")
    listed = written(active.mapInArrow(_lister(size), "node bigint, units array<bigint>").withColumn("n", F.size("units")))
    links = _blocks(groups, listed).groupBy("leader", "lo", "hi").applyInArrow(
        _block_links(similarity), "a bigint, b bigint")
    return extended(labels, written(links.distinct()))


def classes(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE,
) -> DataFrame:
    """(doc_id, row, class_id, class_row): one row per row of ``docs`` (doc_id, text, ...).

    A class is a connected set of texts linked by a similarity of ``similarity`` or more;
    ``class_id`` is its smallest doc_id and ``class_row`` the row hash there. At 0.8 a pair is
    missed by all 48 bands of 8 with probability 1.5e-4, at 0.85 with 3e-7.

    Null counts as the empty text. Texts without words are copies of equal texts only. A text
    of fewer than five words is one run of all its words. A long text costs in proportion to its
    words; blocks of the search count runs of words, so few long texts share one. Repeated rows and repeated ids are
    ordinary rows; a null doc_id is the smallest of all. An empty table gives an empty result. Other columns
    are not read.
    """
    rows_of = written(sketch(docs, bands, rows, size))
    first = F.min(F.struct("doc_id", "row"))
    nodes = written(rows_of.groupBy("node").agg(first.alias("first"), F.first("keys").alias("keys")))

    def texts_of(wanted):
        picked = nodes.join(wanted, "node", "left_semi").select("node", F.col("first.row").alias("row"))
        texts = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")
        return texts.join(picked, "row").dropDuplicates(["node"]).select("node", "text")

    labels = _links(nodes, texts_of, similarity, size)
    if labels is None:
        owner = nodes.select("node", "first")
    else:
        known = nodes.select("node", "first").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        known = written(known)
        least = known.groupBy("comp").agg(F.min("first").alias("least"))
        owner = known.join(least, "comp").select("node", F.col("least").alias("first"))
    return rows_of.select("doc_id", "row", "node").join(owner, "node").select(
        "doc_id", "row", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("class_row"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of its smallest doc_id; all columns are kept."""
    name = fresh(docs, "row")
    winners = written(classes(docs, similarity).where("row = class_row").groupBy("row").agg(F.count("*").alias("copies")))
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text"))

    def of(rows):
        return keyed.join(rows.select(F.col("row").alias(name)), name, "left_semi")

    kept = of(winners)
    repeated = winners.where("copies > 1")
    if not repeated.isEmpty():
        kept = of(winners.where("copies = 1")).unionByName(of(repeated).dropDuplicates([name]))
    return kept.drop(name).select(docs.columns)
