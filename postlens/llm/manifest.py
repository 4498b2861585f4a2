"""Hash manifest of a dataset: a tree of fanout three per source, and one over the sources.

The tree is built by slot pivots. A row of a level's pivot is one parent; conditional aggregates
spread its children into the columns c0, c1 and c2. All columns together hash to the parent, and
the columns without a child's own slot are its siblings. Every table of the way up is a third of
the one before it, and on the way down a parent hands its own proof to its children, so all
levels together shuffle about half as many rows as there are leaves. No tree is held in a task:
a source with most of the rows is spread by parent like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlens.llm.frames import written
from postlens.operators.joins import lookup_join
from postlens.operators.ordering import with_position

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"c{i}" for i in range(FANOUT)]
STEPS = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """Byte count, colon and value, so that no two rows concatenate to the same bytes; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """Digest of a row's columns, with ``text`` in the place of its own text."""
    parts = [encoded(text if name == "text" else F.col(name)) for name in COLUMNS]
    return F.sha2(F.concat(*parts), 256)


def tampered(text: Column) -> Column:
    """Line feeds deleted where the id's checksum is even; a row without an id stays."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def _parent_of(position: Column) -> Column:
    return F.floor((position - position % FANOUT) / FANOUT).cast("bigint")


def pivot(nodes: DataFrame) -> DataFrame:
    """(tree, position, n, c0, c1, c2, digest): the parents of nodes (tree, position, n, digest).

    ``n`` counts the nodes of the tree on the level; trees of one node have no parent.
    """
    position = F.col("position")
    slots = [F.max(F.when(position % FANOUT == i, F.col("digest"))).alias(c) for i, c in enumerate(SLOTS)]
    parent = _parent_of(position).alias("position")
    rows = nodes.where("n > 1").groupBy("tree", parent).agg(F.max("n").alias("n"), *slots)
    return rows.withColumn("n", F.ceil(F.col("n") / FANOUT).cast("bigint")).withColumn(
        "digest", F.sha2(F.concat_ws("", *SLOTS), 256))


def levels(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Pivots of all levels, the lowest first; ``largest`` is the number of nodes of the largest tree."""
    found = []
    while largest > 1:
        nodes = written(pivot(nodes))
        found.append(nodes)
        largest = -(-largest // FANOUT)
    return found


def tops(leaves: DataFrame, pivots: list[DataFrame]) -> DataFrame:
    """(tree, digest): what remains of each tree."""
    out = leaves.where("n = 1").select("tree", "digest")
    for rows in pivots:
        out = out.unionByName(rows.where("n = 1").select("tree", "digest"))
    return out


def _sides(slot: Column) -> Column:
    """Siblings before and after a slot: the columns of the parent without its own."""
    def others(keep):
        return F.concat_ws("", *[F.when(keep(i), F.col(f"p_{c}")) for i, c in enumerate(SLOTS)])
    return F.struct(others(lambda i: slot > i).alias("left"), others(lambda i: slot < i).alias("right"))


def _stepped(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """``nodes`` (tree, position, ...) with the steps of their parents and the one between them."""
    above = parents.select(
        "tree", F.col("position").alias("_parent"), *[F.col(c).alias(f"p_{c}") for c in SLOTS],
        F.col("steps").alias("_above"), "subroot")
    joined = nodes.withColumn("_parent", _parent_of(F.col("position"))).join(above, ["tree", "_parent"])
    steps = F.concat(F.array(_sides(F.col("position") % FANOUT)), F.col("_above"))
    return joined.select(*nodes.columns, steps.alias("steps"), "subroot")


def _topped(nodes: DataFrame, start: DataFrame) -> DataFrame:
    """Nodes that are their whole tree, with the steps that ``start`` (tree, steps, subroot) gives the tree.
    Both sides have one row a tree, so no key is hot."""
    return nodes.where("n = 1").join(start, "tree").select(*nodes.columns, "steps", "subroot")


def proven(leaves: DataFrame, pivots: list[DataFrame], start: DataFrame) -> DataFrame:
    """``leaves`` with ``steps``, the siblings left and right on each level up to the root, and ``subroot``."""
    parents = None
    for rows in reversed([leaves, *pivots]):
        out = _topped(rows, start)
        if parents is not None:
            out = out.unionByName(_stepped(rows.where("n > 1"), parents))
        parents = out if rows is leaves else written(out)
    return parents


def numbered(nodes: DataFrame, order: list[str]):
    """``nodes`` (tree, digest, ...) with ``position`` in their tree and ``n``, and the largest ``n``.

    Positions come from one range partitioning of all rows, so a large tree is split among tasks.
    """
    placed = with_position(nodes, ["tree", *order], "place")
    sizes = written(placed.groupBy("tree").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    count, largest = sizes.agg(F.count("*"), F.max("n")).first()
    placed = lookup_join(placed, sizes, ["tree"], "inner", rows=count)
    return written(placed.withColumn("position", F.col("place") - F.col("first")).drop("place", "first")), largest or 0


def folded(leaf_digest: Column, steps: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf_digest, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified), one row per row of ``docs``.

    ``proof`` is the siblings from leaf to root as one text. ``folded_root`` starts from the
    tampered text's leaf. Null in any column is encoded as ``-`` and differs from the empty text.
    A null source is a tree of its own, before all others; a null doc_id comes first in its source
    and is not tampered with. Equal ids of a source are ordered by leaf; repeated rows are leaves
    of their own with equal digests. A table of one row has its leaf as root and an empty proof;
    an empty table gives no rows. Texts of any length are hashed whole. Columns other than
    doc_id, source, lang, n_chars and text are not read, whatever their names.
    """
    spark = docs.sparkSession
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    hashed = written(docs.select(*COLUMNS).select(
        tree.alias("tree"), "doc_id", leaf(F.col("text")).alias("digest"), leaf(tampered(F.col("text"))).alias("found")))
    leaves, largest = numbered(hashed, ["doc_id", "digest"])
    pivots = levels(leaves, largest)
    subroots = tops(leaves, pivots).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    crowns, n_crowns = numbered(subroots, ["source"])
    crown_pivots = levels(crowns, n_crowns)
    root = tops(crowns, crown_pivots).first()  # one row
    if root is None:
        schema = docs.select("doc_id").schema.add("leaf", "string").add("subroot", "string").add("root", "string")
        return spark.createDataFrame([], schema.add("proof", "string").add("folded_root", "string").add("verified", "boolean"))
    nothing = spark.range(1).select(
        F.lit("").alias("tree"), F.array().cast(STEPS).alias("steps"), F.lit("").alias("subroot"))
    start = written(proven(crowns, crown_pivots, nothing).select(
        F.col("source").alias("tree"), "steps", F.col("digest").alias("subroot")))
    rows = proven(leaves, pivots, start)
    whole = F.lit(root.digest)
    final = folded(F.col("found"), F.col("steps"))
    proof = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", whole.alias("root"),
                       proof.alias("proof"), final.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
