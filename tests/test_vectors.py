"""Neighbours, trees and density clusters against brute force on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import blocks, density, features, grids, layout, models, neighbours, spanning, vectors


def arrays(df):
    rows = df.orderBy("vec_id").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.z for r in rows])


def distances(z):
    d = np.sqrt(((z[:, None] - z[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    return d


def brute_knn(ids, z, k):
    d = np.round(distances(z), 12)
    return {int(i): [int(ids[j]) for j in np.lexsort((ids, d[n]))[:k]] for n, i in enumerate(ids)}


def lists(df):
    out = {}
    for r in df.orderBy("vec_id", "rank").collect():
        out.setdefault(r.vec_id, []).append(r.nbr)
    return out


def planted(spark, n=80, groups=3, dim=4, seed=1):
    rnd = np.random.default_rng(seed)
    z = rnd.normal(size=(n, dim))
    for i in range(n):
        z[i] = z[i] * 30 if i % 13 == 0 else z[i] * 0.4 + 10 * np.eye(dim)[i % groups]
    return spark.createDataFrame([(i, [float(x) for x in z[i]]) for i in range(n)], "vec_id long, z array<double>")


def brute_cores(d, m):
    return np.sort(d, axis=1)[:, m - 1]


def brute_tree(ids, z, m):
    d = distances(z)
    core = brute_cores(d, m)
    w = np.round(np.maximum(d, np.maximum(core[:, None], core[None])), 9)
    edges = sorted((w[i, j], ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1, len(ids)))
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    tree = []
    for weight, a, b in edges:
        if find(a) != find(b):
            parent[find(a)] = find(b)
            tree.append((int(a), int(b), float(weight)))
    return tree


def brute_hdbscan(ids, tree, m, epsilon=0.0):
    """Straight recursion over connected sets of the tree."""
    order = sorted(tree, key=lambda e: (e[2], e[0], e[1]))
    clusters = []

    def sides(members, edges):
        top = edges[-1]
        rest = edges[:-1]
        near = {x: [] for x in members}
        for a, b, _ in rest:
            near[a].append(b)
            near[b].append(a)
        seen, todo = {top[0]}, [top[0]]
        while todo:
            for y in near[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        other = members - seen
        return top[2], (seen, [e for e in rest if e[0] in seen]), (other, [e for e in rest if e[0] in other])

    def grow(members, edges, birth, parent):
        me = len(clusters)
        clusters.append({"members": set(members), "birth": birth, "parent": parent, "children": [], "stability": 0.0})
        born = 0.0 if birth is None else 1 / birth
        while len(members) >= m and edges:
            weight, a, b = sides(members, edges)
            big = [s for s in (a, b) if len(s[0]) >= m]
            for s in (a, b):
                if len(s[0]) < m or len(big) == 2:
                    clusters[me]["stability"] += len(s[0]) * (1 / weight - born)
            if len(big) == 2:
                for s in big:
                    clusters[me]["children"].append(grow(*s, weight, me))
                return me
            if not big:
                return me
            members, edges = big[0]
        return me

    grow(set(ids.tolist()), order, None, None)

    def best(c):
        below = [best(x) for x in clusters[c]["children"]]
        total, picked = sum(v for v, _ in below), [p for _, ps in below for p in ps]
        if c != 0 and clusters[c]["stability"] >= total:
            return clusters[c]["stability"], [c]
        return total, picked

    chosen = best(0)[1]
    if epsilon:
        raised = set()
        for c in chosen:
            while clusters[c]["birth"] < epsilon and clusters[c]["parent"] not in (None, 0):
                c = clusters[c]["parent"]
            raised.add(c)
        chosen = [c for c in raised if not any(clusters[c]["members"] < clusters[o]["members"] for o in raised)]
    sets = sorted((clusters[c]["members"] for c in chosen), key=lambda s: (-len(s), min(s)))
    return {int(i): next((n for n, s in enumerate(sets) if i in s), -1) for i in ids}


def labels(df):
    return {r.vec_id: r.cluster for r in df.collect()}


@pytest.mark.parametrize("block_rows", [2048, 40])
def test_knn_is_exact(embeddings, block_rows):
    ids, z = arrays(embeddings)
    assert lists(neighbours.knn(embeddings, 10, block_rows)) == brute_knn(ids, z, 10)


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_knn_with_a_third_of_all_rows_equal(spark, block_rows):
    base = planted(spark, 40)
    one = base.where("vec_id = 3").select(F.explode(F.expr("sequence(100L, 125L)")).alias("vec_id"), "z")
    few = base.where("vec_id = 8").select(F.explode(F.expr("sequence(200L, 202L)")).alias("vec_id"), "z")
    df = base.unionByName(one).unionByName(few)
    ids, z = arrays(df)
    assert lists(neighbours.knn(df, 6, block_rows)) == brute_knn(ids, z, 6)


def test_cells_rule_out_far_blocks(spark):
    rows, cells = blocks.split(planted(spark, 78), 8)
    packed = blocks.pack(rows)
    every = blocks.pairs(packed, cells).count()
    n = int(cells.parts[cells.rows > 0].sum())
    assert every == n * (n + 1) // 2
    assert blocks.pairs(packed, cells, neighbours._wanted_cells(cells, 2)).count() < every


@pytest.mark.parametrize("block_rows", [None, 9])
def test_neighbours_of_new_rows(spark, block_rows):
    fitted = planted(spark, 50)
    new = planted(spark, 20, seed=5).withColumn("vec_id", F.col("vec_id") + 1000)
    ids, z = arrays(fitted)
    new_ids, new_z = arrays(new)
    want = {}
    for i, row in zip(new_ids, new_z):
        d = np.sqrt(((z - row) ** 2).sum(1))
        want[int(i)] = [int(ids[j]) for j in np.lexsort((ids, d))[:4]]
    assert lists(neighbours.neighbours_of_new(new, fitted, 4, block_rows)) == want


def test_sigma_solves_its_equation(embeddings):
    rows = neighbours.bandwidths(neighbours.knn(embeddings, 8)).collect()
    for r in rows:
        total = sum(np.exp(-max(0.0, d - r.rho) / r.sigma) for d in r.dists)
        assert abs(total - 3.0) < 1e-6
    edges = neighbours.fuzzy_edges(neighbours.knn(embeddings, 8)).collect()
    assert all(e.a < e.b and 0 < e.weight <= 1 + 1e-12 for e in edges)


@pytest.mark.parametrize("block_rows, tail", [(None, None), (12, None), (20, 0)])
def test_tree_is_the_minimum(spark, block_rows, tail):
    df = planted(spark, 40)
    ids, z = arrays(df)
    got = density.reachability(df, 4, block_rows, tail)
    assert sorted((r.a, r.b, round(r.weight, 9)) for r in got.collect()) == sorted(brute_tree(ids, z, 4))


def test_tree_with_copies_spans_all_rows(spark):
    df = planted(spark, 30)
    df = df.unionByName(df.where("vec_id = 4").select(F.explode(F.expr("sequence(50L, 60L)")).alias("vec_id"), "z"))
    ids, z = arrays(df)
    got = density.reachability(df, 4).collect()
    assert len(got) == len(ids) - 1
    assert abs(sum(r.weight for r in got) - sum(w for _, _, w in brute_tree(ids, z, 4))) < 1e-6


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (11, 12), (12, 10), (20, 21)]
    df = spark.createDataFrame(edges, "a long, b long")
    for tail in (None, 0):
        got = {}
        for r in spanning.components(df, tail).collect():
            got.setdefault(r.root, set()).add(r.vec_id)
        assert sorted(map(sorted, got.values())) == [[1, 2, 3], [10, 11, 12], [20, 21]]


@pytest.mark.parametrize("m, epsilon", [(5, 0.0), (8, 0.0), (5, 3.0)])
def test_hdbscan_against_recursion(spark, m, epsilon):
    df = planted(spark, 80)
    ids, z = arrays(df)
    tree = density.reachability(df, 5)
    want = brute_hdbscan(ids, brute_tree(ids, z, 5), m, epsilon)
    assert labels(density.hdbscan(df, m, epsilon=epsilon, tree=tree)) == want


def test_hierarchy_in_parts_equals_hierarchy_in_one(spark):
    df = planted(spark, 60)
    tree = density.reachability(df, 4)
    whole = labels(density.hdbscan(df, 5, tree=tree))
    assert labels(density.hdbscan(df, 5, tree=tree, part_edges=20)) == whole
    assert max(whole.values()) >= 1


def test_flat_cut_names_components(spark):
    df = planted(spark, 60)
    cores = neighbours.core_distance(neighbours.knn(df, 4), 4)
    tree = spanning.reachability_tree(df, cores)
    got = labels(density.flat_cut(df, tree, cores, 3.0))
    ids, z = arrays(df)
    d = distances(z)
    core = brute_cores(d, 4)
    near = np.maximum(d, np.maximum(core[:, None], core[None])) <= 3.0
    reach = np.linalg.matrix_power(near.astype(int) + np.eye(len(ids), dtype=int), 6) > 0
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    want = {int(i): int(ids[np.flatnonzero(reach[n])[0]]) if core[n] <= 3.0 else -1 for n, i in enumerate(ids)}
    assert got == want


def test_silhouette_does_not_depend_on_blocks(embeddings):
    one = vectors.silhouette(embeddings).first().silhouette
    many = vectors.silhouette_rows(embeddings, 90).agg(F.avg("silhouette")).first()[0]
    assert abs(one - many) < 1e-9


def trust(before, after, k):
    """Share of each row's k nearest neighbours that are among its k nearest in the layout."""
    near, placed = brute_knn(*arrays(before), k), brute_knn(*arrays(after), k)
    return np.mean([len(set(near[i]) & set(placed[i])) / k for i in near])


def test_full_layout_keeps_neighbours_better_than_a_short_one(spark):
    """200 steps in blocks of 40 rows with exchanges, against 8 steps and against chance."""
    df = planted(spark, 150, groups=4, dim=6)
    full = layout.fit(df, dim=2, n_neighbors=8, layout_rows=40).cache()
    short = layout.fit(df, dim=2, n_neighbors=8, steps=8, layout_rows=40)
    ids, z = arrays(full)
    assert len(ids) == 150 and np.isfinite(z).all()
    assert trust(df, full, 8) > max(trust(df, short, 8), 5 * 8 / 149)
    # new rows of a group land among the fitted rows of that group
    new = planted(spark, 40, groups=4, dim=6, seed=9).withColumn("vec_id", F.col("vec_id") + 1000)
    moved = layout.place_new(new, df, full, 8, steps=50)
    group = {int(i): int(i) % 4 for i in range(2000) if i % 1000 % 13}
    new_ids, at = arrays(moved)
    good = [group[int(ids[np.argmin(((z - p) ** 2).sum(1))])] == group[int(i)] % 4
            for i, p in zip(new_ids, at) if int(i) in group and int(ids[np.argmin(((z - p) ** 2).sum(1))]) in group]
    assert len(good) > 25 and np.mean(good) > 0.9


def test_density_term_keeps_radii(spark):
    """With the density term, the spread around a row in the layout follows that in the input."""
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=4) * (0.05 if i % 2 else 3.0) + 30 * (i % 2)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, z array<double>")
    before = np.log(np.sort(distances(arrays(df)[1]), axis=1)[:, :6].mean(axis=1))

    def agreement(weight):
        z = arrays(layout.fit(df, dim=2, n_neighbors=6, steps=40, density_weight=weight, epochs=5))[1]
        return np.corrcoef(before, np.log(np.sort(distances(z), axis=1)[:, :6].mean(axis=1)))[0, 1]

    with_term = agreement(4.0)
    assert with_term > 0.5 and with_term > agreement(0.0)


def test_popular_row_is_not_thrown_about(spark):
    """One row that is everyone's neighbour belongs to every block; its moves are averaged."""
    rnd = np.random.default_rng(5)
    z = rnd.normal(size=(120, 8))
    z = z / np.linalg.norm(z, axis=1)[:, None]
    z[0] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in z[i]]) for i in range(120)], "vec_id long, z array<double>")
    at = arrays(layout.fit(df, dim=2, n_neighbors=5, steps=20, layout_rows=15))[1]
    assert np.isfinite(at).all() and np.abs(at).max() < 60


def labelled(spark, n=90):
    rows = planted(spark, n)
    labels = F.array((F.col("vec_id") % 3).cast("int"), F.when(F.col("vec_id") < 2, 7).otherwise(1), F.lit(5), (F.col("vec_id") % 40).cast("int"))
    return rows.withColumn("labels", labels)


def test_scores_of_many_labellings_equal_single_ones(spark):
    df = labelled(spark).cache()
    many = {r.g: r.silhouette for r in grids.silhouettes(df, 16).collect()}
    index = {r.g: r.db for r in grids.davies_bouldin(df).collect()}
    for g in range(4):
        one = df.select("vec_id", "z", F.col("labels")[g].alias("cluster"))
        assert abs(many[g] - vectors.silhouette(one).first().silhouette) < 1e-9
        want = vectors.davies_bouldin(one).first().davies_bouldin
        assert index[g] is None if want is None else abs(index[g] - want) < 1e-9


def test_kmeans_of_many_k(spark):
    df = planted(spark, 80)
    ids, z = arrays(df)
    found, centres = grids.kmeans_many(df, [1, 3, 5, 200])
    by_k = np.array([r.labels for r in found.orderBy("vec_id").collect()])
    for g, k in enumerate([1, 3, 5, 200]):
        d = ((z[:, None] - centres[k][None]) ** 2).sum(axis=2)
        assert (d[np.arange(len(z)), by_k[:, g]] <= d.min(axis=1) + 1e-9).all()
        for c in range(len(centres[k])):
            if k < 200 and (by_k[:, g] == c).any():
                assert np.allclose(centres[k][c], z[by_k[:, g] == c].mean(axis=0), atol=0.05)
    inertia = [((z - centres[k][by_k[:, g]]) ** 2).sum() for g, k in enumerate([1, 3, 5, 200])]
    assert inertia == sorted(inertia, reverse=True) and inertia[-1] < 1e-9
    assert grids.kmeans_many(df.where("false"), [2, 3])[0].count() == 0


def test_curve_falls_from_one():
    alpha, beta = layout.curve()
    assert 1.4 < alpha < 1.7 and 0.85 < beta < 0.95


def test_models(spark, embeddings):
    model, rows = models.kmeans(planted(spark, 60), 3)
    centres = model.clusterCenters()
    for r in rows.collect():
        d = [np.linalg.norm(np.array(r.z) - c) for c in centres]
        assert d[r.cluster] <= min(d) + 1e-9
    docs = spark.createDataFrame([(i, ["a", "b", "c"][: i % 4]) for i in range(40)], "id long, t array<string>")
    words, lda, _ = models.topics(docs, "t", k=2, iterations=3)
    top = models.describe_topics(words, lda, 3).collect()
    assert len(top) == 2
    for r in top:
        assert sorted(r.topic_words) == ["a", "b", "c"] and list(r.weights) == sorted(r.weights, reverse=True)
    grid = models.density_grid({4: planted(spark, 60)}, [5], [0.0, 3.0], min_samples=4)
    assert {r.status for r in grid.select("status").distinct().collect()} == {"ok"}


def test_topics_part_two_kinds_of_documents(spark):
    """Also with ids that repeat; the vocabulary is a table, not a list on the driver."""
    words = [["sun", "sea", "sand"], ["snow", "ski", "ice"]]
    docs = [(i // 2, [words[i % 2][(i + j) % 3] for j in range(3 + i % 4)]) for i in range(400)] + [(7, [])]
    df = spark.createDataFrame(docs, "id long, t array<string>")
    vocabulary, model, rows = models.topics(df, "t", k=2, iterations=25)
    assert {r.term: round(r.idf, 9) for r in vocabulary.collect()}.keys() == {w for part in words for w in part}
    shares = model.transform(rows).collect()
    assert len(shares) == 400 and all(abs(sum(r.share) - 1) < 1e-9 for r in shares)
    top = [set(r.topic_words) for r in models.describe_topics(vocabulary, model, 3).orderBy("topic").collect()]
    assert sorted(map(sorted, top)) == sorted(map(sorted, words))
    weights = model.weights().collect()
    assert np.allclose(np.sum([[r.l0, r.l1] for r in weights], axis=0), model.totals)
    score = {r.k: r.log_perplexity for r in models.perplexity(df, "t", [1, 2], iterations=25).collect()}
    assert 0 < score[2] < score[1] < 10


def test_blocks_travel_once_for_each_group(spark, monkeypatch):
    """Silhouettes, neighbours and trees send a block to the groups that want it, not to every other block."""
    df = planted(spark, 160).withColumn("cluster", (F.col("vec_id") % 3).cast("int"))
    monkeypatch.setattr(blocks, "GROUP_BLOCKS", 64)
    monkeypatch.setattr(blocks, "cores_of", lambda spark: 2)
    sent, real = [], blocks._sent

    def counting(*args):
        out = real(*args)
        sent.append(out.count())
        return out

    monkeypatch.setattr(blocks, "_sent", counting)
    ids, z = arrays(df)
    assert lists(neighbours.knn(df, 5, 4)) == brute_knn(ids, z, 5)
    tree = density.reachability(df, 4, 4).collect()
    assert sorted((r.a, r.b, round(r.weight, 9)) for r in tree) == sorted(brute_tree(ids, z, 4))
    one = vectors.silhouette(df).first().silhouette
    assert abs(one - vectors.silhouette_rows(df, 4).agg(F.avg("silhouette")).first()[0]) < 1e-9
    blocks_ = int(blocks.split(df.select("vec_id", "z"), 4)[1].parts.sum())
    assert blocks_ > 40 and max(sent) <= 10 * blocks_


def test_a_block_of_neighbours_travels_once_for_each_core(spark, monkeypatch):
    """Its numbers take four bytes if they have a four-byte form, and come back unchanged in either."""
    df = planted(spark, 160)
    exact = df.withColumn("z", F.transform("z", lambda x: x.cast("float").cast("double")))
    monkeypatch.setattr(blocks, "cores_of", lambda spark: 2)
    sent, real = [], blocks._sent

    def counting(*args):
        out = real(*args)
        sent.append(out.select("n", "dim", F.length("vectors").alias("bytes")).collect())
        return out

    monkeypatch.setattr(blocks, "_sent", counting)
    for rows, size in ((df, 8), (exact, 4)):
        ids, z = arrays(rows)
        sent.clear()
        assert lists(neighbours.knn(rows, 5, 4)) == brute_knn(ids, z, 5)
        n_blocks = int(blocks.split(rows.select("vec_id", "z"), 4)[1].parts.sum())
        assert n_blocks > 40 and len(sent[0]) <= 2 * n_blocks
        if size == 4:
            assert all(r.bytes == 4 * r.n * r.dim for r in sent[0])
    odd = np.array([[0.1, np.nan, np.inf], [-0.0, 1e300, 2.0]])
    for z in (odd, np.array([[1.5, -0.0, 3.0]]), np.zeros((2, 0))):
        row = type("Row", (), dict(ids=np.arange(len(z)).tobytes(), vectors=blocks._narrow(z).tobytes(), extra=b"", kind="int64",
                                   n=len(z), dim=z.shape[1], block=0, cell=0))
        assert blocks.unpack(row).vectors.tobytes() == z.tobytes()


def test_tree_edges_are_found_once(spark, monkeypatch):
    df = planted(spark, 60)
    calls = spark.sparkContext.accumulator(0)
    real = spanning._pair_tree

    def counting(a, b):
        calls.add(1)
        return real(a, b)

    monkeypatch.setattr(spanning, "_pair_tree", counting)
    density.reachability(df, 4, 20)
    assert 0 < calls.value <= 36


def test_own_encoder(spark):
    df = spark.createDataFrame([(0, "abc"), (1, "")], "id long, text string")
    rows = features.embed_with(df, "text", lambda ts: [[len(t), 1] for t in ts]).orderBy("id").collect()
    assert [r.z for r in rows] == [[3.0, 1.0], [0.0, 1.0]]


def random_hierarchy(seed, n, m=0):
    """Binary hierarchy of n splits: rows (m, cluster, parent, birth, size, stability), names falling from parent to part."""
    rnd = np.random.default_rng(seed)
    rows, leaves, name = [(m, -10 * n, None, None, 1000, 5.0)], [(-10 * n, 100.0)], -10 * n
    for _ in range(n):
        parent, birth = leaves.pop(int(rnd.integers(len(leaves))))
        birth = birth * float(rnd.uniform(0.7, 1.0))
        for _ in range(2):
            name += 1
            leaves.append((name, birth))
            rows.append((m, name, parent, birth, 10, float(rnd.integers(0, 9)) / 4))
    return rows


TABLE = "m int, cluster long, parent long, birth double, size long, stability double"


def selections(df):
    return {(r.m, r.cluster): list(r.selected) for r in df.collect()}


def test_selection_by_contraction_equals_selection_in_a_task(spark):
    rows = [r for m, n in enumerate([0, 1, 2, 7, 40, 150]) for r in random_hierarchy(m, n, m)]
    table = spark.createDataFrame(rows, TABLE)
    epsilons = [0.0, 5.0, 30.0, 80.0, 1000.0]
    assert selections(density.choose_all(table, epsilons, tail_clusters=0)) == selections(density.choose_all(table, epsilons))


def test_selection_on_a_chain(spark):
    """A hundred thousand clusters, each split below the one before: every split parts one final cluster from the rest."""
    n = 50_000
    i = F.col("id")
    chain = spark.range(2 * n).select(
        F.lit(0).alias("m"), (i - 2 * n).alias("cluster"),
        F.when(i < 2, F.lit(-2 * n - 1)).otherwise((i - i % 2) - 2 * n - 1).cast("long").alias("parent"),
        (1.0 / (1 + F.floor(i / 2))).alias("birth"), F.lit(10).cast("long").alias("size"),
        F.when(i % 2 == 0, 1.0).otherwise(F.when(i == 2 * n // 2 + 1, float(3 * n)).otherwise(0.5)).alias("stability"))
    root = spark.range(1).select(
        F.lit(0).alias("m"), F.lit(-2 * n - 1).cast("long").alias("cluster"), F.lit(None).cast("long").alias("parent"),
        F.lit(None).cast("double").alias("birth"), F.lit(20).cast("long").alias("size"), F.lit(1.0).alias("stability"))
    found = density.choose_all(chain.unionByName(root), [0.0]).select("cluster", F.col("selected")[0].alias("selected"))
    strong = 2 * n // 2 + 1 - 2 * n  # the part in the middle that outweighs all below it
    counts = {r.selected: r.n for r in found.groupBy("selected").agg(F.count("*").alias("n")).collect()}
    assert counts[strong] == 1 + (2 * n - 1 - (2 * n // 2 + 1))
    assert sum(counts.values()) == 2 * n + 1
    assert found.where("selected = cluster").count() == n // 2 + 2


@pytest.mark.parametrize("min_samples", [None, 5])
def test_density_grid_equals_separate_fits(spark, min_samples):
    reduced = {4: planted(spark, 80)} if min_samples is None else {4: planted(spark, 60), 3: planted(spark, 40, dim=3, seed=2)}
    ms, epsilons = [5, 8, 1], [0.0, 3.0]
    grid = models.density_grid(reduced, ms, epsilons, min_samples)
    found = {}
    for r in grid.where("status = 'ok'").collect():
        found.setdefault((r.d, r.m, r.eps), {})[r.vec_id] = r.cluster
    for d, rows in reduced.items():
        for m in (5, 8):
            points, table = density.hierarchy(density.reachability(rows, min_samples or m), m)
            points, table = points.cache(), table.cache()
            for e in epsilons:
                assert found.pop((d, m, e)) == labels(density.label(points, density.choose(table, e)))
    assert not found
    refused = grid.where("status <> 'ok'").groupBy("d", "m", "eps").count().collect()
    assert sorted((r.d, r.m, r.eps) for r in refused) == sorted((d, 1, e) for d in reduced for e in epsilons)
