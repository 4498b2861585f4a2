"""Near duplicates among embeddings against all pairs, and their odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from postlens.llm import vector_dedup as V

FOLDER = "/root/testdata/sf0.01"


def truth(ids, vectors, cosine=0.95):
    """(n_links, component_id) of each row by comparing all pairs."""
    n = len(ids)
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    up = np.arange(n)

    def find(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    links = np.zeros(n, int)
    for size in {len(v) for v, g in zip(vectors, good) if g}:
        at = np.array([i for i in range(n) if good[i] and len(vectors[i]) == size])
        z = np.array([vectors[i] for i in at], "float64")
        z /= np.linalg.norm(z, axis=1)[:, None]
        near = z @ z.T >= cosine
        np.fill_diagonal(near, False)
        links[at] = near.sum(axis=1)
        for i, j in zip(*np.nonzero(np.triu(near))):
            up[find(at[j])] = find(at[i])
    roots = [find(i) for i in range(n)]
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, int(k), least[r], i is not None and i == least[r]) for i, k, r in zip(ids, links, roots)]


def found(frame, **options):
    return sorted((tuple(r) for r in V.near_duplicates(frame, **options).collect()), key=str)


def frame(spark, ids, vectors, kind="float"):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 3, "r", 1) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, row int, leaves string, ball int")


def groups(seed, sizes, noise, dim=64):
    """Unrelated vectors around which groups of near copies lie."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((len(sizes), dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    parts = [c + noise * rng.standard_normal((n, dim)) / np.sqrt(dim) for c, n in zip(centres, sizes)]
    return np.concatenate(parts).astype("float32")


def test_odd_vectors(spark):
    vectors = [
        [1, 0, 0], [1, 0, 0], [2, 0, 0], [1, 0.1, 0], [0, 0, 0], None, [], [None, 1, 0], [float("nan"), 1, 0],
        [float("inf"), 1, 0], [0, 1, 0], [1, 0], [1e-30, 0, 0], [-1, 0, 0], [0, 1, 0], [3e38, 1e37, 0],
    ]
    ids = [5, 4, 7, 7, 8, 9, 10, 11, 12, 13, None, 15, 16, 17, None, 2]
    assert found(frame(spark, ids, vectors)) == sorted(truth(ids, vectors), key=str)


def test_empty(spark):
    assert V.near_duplicates(frame(spark, [], [])).count() == 0
    only = V.near_duplicates(frame(spark, [1, 2], [None, [0, 0]])).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("noise", [0.1, 0.24])
def test_recall_of_groups(spark, noise):
    """Many small groups, some of them with links right at the threshold, in leaves of 200 rows."""
    vectors = groups(1, [1] * 1500 + [2] * 300 + [7] * 40 + [120], noise)
    ids = list(range(len(vectors)))
    mine = V.near_duplicates(frame(spark, ids, vectors), leaf_rows=200).collect()
    want = {w[0]: w for w in truth(ids, vectors)}
    assert len(mine) == len(ids)
    assert all(r.n_links <= want[r.vec_id][1] for r in mine)
    all_links = sum(w[1] for w in want.values())
    assert all_links > 500
    assert sum(r.n_links for r in mine) >= 0.99 * all_links


def test_large_groups_become_balls(spark):
    """A group larger than a leaf is linked without being cut apart, and exactly counted with its neighbours."""
    vectors = groups(2, [1] * 1000 + [900] + [40] * 5, 0.12)
    ids = list(range(len(vectors)))
    rows = frame(spark, ids, vectors).select(F.col("vec_id").alias("row"), F.lit(1).cast("long").alias("weight"), F.col("embedding").alias("v"))
    placed = V.forest(rows, leaf_rows=300)
    assert placed.where("ball IS NOT NULL").count() > 800
    assert found(frame(spark, ids, vectors), leaf_rows=300) == sorted(truth(ids, vectors), key=str)


def test_shapeless_rows_are_compared_in_blocks(spark):
    """Rows that no cut separates stay in one leaf and are compared block by block, none left out."""
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((900, 3)) / 20 + [1, 1, 1]).astype("float32")
    ids = list(range(len(vectors)))
    assert found(frame(spark, ids, vectors), leaf_rows=100) == sorted(truth(ids, vectors), key=str)


def test_query_against_all_pairs(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = truth([r.vec_id for r in rows], [r.embedding for r in rows])
    mine = entry.queries()["op13_vector_duplicates"](spark, FOLDER)
    assert sorted((tuple(r) for r in mine.collect()), key=str) == sorted(want, key=str)
