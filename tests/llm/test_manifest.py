"""The hash manifest against a tree built in plain Python, and its odd inputs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from postlens.llm import manifest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree string, n int, position int, digest int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h("".join(encoded(x) for x in (row[0], row[3], row[2], row[4], text)))


def paths(digests):
    """Root, and for each digest its (left, right) siblings on each level."""
    nodes = [(d, [i]) for i, d in enumerate(digests)]
    steps = [[] for _ in digests]
    while len(nodes) > 1:
        above = []
        for k in range(0, len(nodes), 3):
            run = nodes[k:k + 3]
            for s, (_, inside) in enumerate(run):
                step = "".join(d for d, _ in run[:s]), "".join(d for d, _ in run[s + 1:])
                for i in inside:
                    steps[i].append(step)
            above.append((h("".join(d for d, _ in run)), [i for _, inside in run for i in inside]))
        nodes = above
    return nodes[0][0], steps


def expected(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        placed = sorted(((r, leaf(r, r[1])) for r in sources[name]), key=lambda p: (p[0][0] is not None, p[0][0] or 0, p[1]))
        trees.append((placed, *paths([d for _, d in placed])))
    root, crown = paths([t[1] for t in trees])
    out = []
    for (placed, subroot, steps), above in zip(trees, crown):
        for (r, digest), own in zip(placed, steps):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            fold = leaf(r, text)
            for left, right in own + above:
                fold = h(left + fold + right)
            proof = "".join(a + b for a, b in own + above)
            out.append((r[0], digest, subroot, root, proof, fold, fold == root))
    return sorted(map(str, out))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], COLUMNS)


def rows_of(n, source):
    return [(i, f"line {i}\nnext ü {i}", "en", source, i * 7) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 3, "b": 4}, {"b": 28, "a": 9, "ä": 2, None: 10, "z": 1}])
def test_manifest_agrees_with_python(spark, sizes):
    rows = [r for source, n in sizes.items() for r in rows_of(n, source)]
    assert sorted(str(tuple(r)) for r in manifest.manifest(frame(spark, rows)).collect()) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, "no id\n", "en", "a", 1), (1, None, None, None, None), (1, "", None, None, None), (2, "same\n", "en", "a", 5),
        (2, "same\n", "en", "a", 5), (2, "other", "en", "a", 5), (3, "word \n" * 100_000, "de", "", 9),
    ]
    found = manifest.manifest(frame(spark, rows))
    assert sorted(str(tuple(r)) for r in found.collect()) == expected(rows)
    assert found.select("leaf").distinct().count() == 6


def test_empty(spark):
    found = manifest.manifest(frame(spark, []))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    assert found.count() == 0


def test_one_source_is_spread(spark):
    """The pivot of a single large tree has as many rows as it has parents, in many tasks."""
    rows = spark.range(3000).select(F.lit("=a").alias("tree"), F.col("id").alias("position"), F.lit(3000).alias("n"),
                                    F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    parents = manifest.pivot(rows)
    assert parents.count() == 1000
    per_task = [r["count"] for r in parents.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1000
