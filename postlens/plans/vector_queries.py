"""Queries over term weights, vectors, clusters and fitted models."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.functions import text as tx, tokens as tk
from postlens.operators import density, features, grids, layout, models, neighbours, spanning, tokens as tok, vectors
from postlens.plans import sql_views as v
from postlens.plans.registry import query
from postlens.plans.token_queries import CFG, _FEATURES
from postlens.session import cut
from postlens.sources import readers, views

K = 10
MIN_SAMPLES = 5
#: Factor of the density term that was tried.
DENSITY = 4.0


def _vectors(spark, folder):
    rows = readers.table(spark, folder, "embeddings")
    z = F.transform("embedding", lambda x: x.cast("double"))
    return rows.select("vec_id", z.alias("z"), F.col("label").alias("cluster"))


def _planted(spark, folder):
    """Five groups around far-apart centres, every 17th row scattered as noise."""
    scattered = F.col("vec_id") % 17 == 0
    z = F.transform("z", lambda x, i: F.when(scattered, 40 * x).otherwise(
        F.when(i == F.col("vec_id") % 5, 20.0).otherwise(0.0) + 0.1 * x))
    return _vectors(spark, folder).select("vec_id", z.alias("z"))


def _rounded(df, *names, digits=6):
    for name in names:
        df = df.withColumn(name, F.round(name, digits) + 0.0)
    return df


# -- term weights ---------------------------------------------------------------------------

_TERMS = f"""{v.TOKENS}, terms AS (SELECT id, lower(token) AS term FROM tokens WHERE regexp_matches(token, '[0-9A-Za-z]')),
tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT id, term, tf, tf * ln(((SELECT count(*) FROM texts) + 1) / (df + 1)) AS weight FROM tf JOIN df USING (term))"""


def _frequency(texts):
    rows = tok.token_rows(texts).where(F.col("token").rlike(f"[{tx.ALNUM}]"))
    return features.term_frequency(rows.select("id", F.lower("token").alias("term")), "term")


def _weights(texts):
    return features.tfidf(_frequency(texts), texts.select("id").agg(F.count("*")).scalar())


@query("term_frequency", f"WITH {_TERMS} SELECT id, term, tf FROM tf")
def term_frequency(spark, folder):
    return _frequency(views.texts(spark, folder, pieces=True))


@query("tfidf", f"WITH {_TERMS} SELECT id, term, tf, round(weight, 6) AS weight FROM weights")
def tfidf(spark, folder):
    return _rounded(_weights(views.texts(spark, folder, pieces=True)), "weight")


@query("ngram_tfidf", f"""WITH {_FEATURES}, tf AS (SELECT id, ngram AS term, count(*) AS tf FROM grams WHERE ngram <> '' GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT id, term, tf, round(tf * ln(((SELECT count(*) FROM texts) + 1) / (df + 1)), 6) AS weight FROM tf JOIN df USING (term)""")
def ngram_tfidf(spark, folder):
    texts = views.texts(spark, folder, pieces=True)
    grams = tok.rows_of(tok.topic_features(texts, CFG), "ngrams", ["id"], "pos", "ngram")
    weights = features.tfidf(features.term_frequency(grams, "ngram"), texts.agg(F.count("*")).scalar())
    return _rounded(weights, "weight")


@query("hash_embed", f"""WITH {_TERMS}, h AS (SELECT id, ('0x' || substr(md5(term), 1, 4))::BIGINT % 64 AS dim,
sum(CASE WHEN substr(md5(term), 5, 1) >= '8' THEN -weight ELSE weight END) AS x FROM weights GROUP BY 1, 2),
n AS (SELECT id, sqrt(sum(x * x)) AS norm FROM h GROUP BY id),
g AS (SELECT id, dim FROM texts, (SELECT unnest(range(64)) AS dim))
SELECT id, dim, round(coalesce(CASE WHEN norm > 0 THEN x / norm ELSE x END, 0), 6) + 0.0::DOUBLE AS value
FROM g LEFT JOIN h USING (id, dim) LEFT JOIN n USING (id)""")
def hash_embed(spark, folder):
    texts = views.texts(spark, folder, pieces=True)
    rows = features.hash_embed(_weights(texts), texts)
    return _rounded(rows.select("id", F.posexplode("z").alias("dim", "value")), "value")


@query("random_projection", "SELECT vec_id, " + ", ".join(
    "round((" + " + ".join(f"{int(s)} * embedding[{i + 1}]::DOUBLE" for i, s in enumerate(row)) + f") / sqrt(5), 6) + 0.0::DOUBLE AS z{j}"
    for j, row in enumerate(vectors.projection_signs(64, 5))) + " FROM embeddings")
def random_projection(spark, folder):
    rows = vectors.random_projection(_vectors(spark, folder).select("vec_id", "z"), 64, 5)
    return _rounded(rows.select("vec_id", *vectors.columns("z", 5)), *[f"z{i}" for i in range(5)])


@query("pca_reduce")
def pca_reduce(spark, folder):
    return models.pca(_vectors(spark, folder), 5).select("vec_id", *vectors.columns("z", 5))


# -- neighbours ----------------------------------------------------------------------------------

def _knn_sql(k, table="v"):
    return f"""pairs AS (SELECT a.vec_id, b.vec_id AS nbr, list_distance(a.z, b.z) AS dist
FROM {table} a JOIN {table} b ON a.vec_id <> b.vec_id),
knn AS (SELECT vec_id, nbr, dist, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr) AS rank FROM pairs
QUALIFY rank <= {k})"""


_V = "v AS (SELECT vec_id, embedding::DOUBLE[] AS z, label FROM embeddings)"
_REACH = f"""{_V}, {_knn_sql(MIN_SAMPLES)}, cores AS (SELECT vec_id, max(dist) AS core FROM knn GROUP BY vec_id)"""


@query("knn_graph", f"WITH {_V}, {_knn_sql(K)} SELECT vec_id, rank, nbr, round(dist, 6) AS dist FROM knn")
def knn_graph(spark, folder):
    return _rounded(neighbours.knn(_vectors(spark, folder), K), "dist")


@query("core_distance", f"WITH {_REACH} SELECT vec_id, round(core, 6) AS core FROM cores")
def core_distance(spark, folder):
    near = neighbours.knn(_vectors(spark, folder), MIN_SAMPLES)
    return _rounded(neighbours.core_distance(near, MIN_SAMPLES), "core")


@query("mutual_reachability", f"""WITH {_REACH} SELECT k.vec_id, nbr, round(greatest(a.core, b.core, dist), 6) AS weight
FROM knn k JOIN cores a ON a.vec_id = k.vec_id JOIN cores b ON b.vec_id = k.nbr""")
def mutual_reachability(spark, folder):
    near = cut(neighbours.knn(_vectors(spark, folder), MIN_SAMPLES))
    edges = neighbours.with_cores(near, neighbours.core_distance(near, MIN_SAMPLES))
    return _rounded(edges.select("vec_id", "nbr", "weight"), "weight")


@query("neighbour_rho", f"""WITH {_V}, {_knn_sql(K)} SELECT vec_id, round(min(dist) FILTER (dist > 0), 6) AS rho
FROM knn GROUP BY vec_id""")
def neighbour_rho(spark, folder):
    return _rounded(neighbours.rho(neighbours.knn(_vectors(spark, folder), K)), "rho")


_FUZZY = f"""{_V}, {_knn_sql(K)}, r AS (SELECT vec_id, min(dist) AS rho, list(dist ORDER BY rank) AS ds FROM knn GROUP BY vec_id),
s AS (WITH RECURSIVE b AS (
  SELECT vec_id, rho, ds, 0 AS step, 0.0::DOUBLE AS lo, 'inf'::DOUBLE AS hi, 1.0::DOUBLE AS mid FROM r
  UNION ALL
  SELECT vec_id, rho, ds, step + 1, CASE WHEN up THEN lo ELSE mid END, CASE WHEN up THEN mid ELSE hi END,
         CASE WHEN up THEN (lo + mid) / 2 WHEN isinf(hi) THEN mid * 2 ELSE (mid + hi) / 2 END
  FROM (SELECT *, list_sum(list_transform(ds, lambda d: exp(-greatest(0, d - rho) / mid))) > log2({K}) AS up FROM b)
  WHERE step < 64) SELECT vec_id, rho, mid AS sigma FROM b WHERE step = 64),
directed AS (SELECT k.vec_id, nbr, dist, exp(-greatest(0, dist - rho) / sigma) AS weight FROM knn k JOIN s USING (vec_id)),
edges AS (SELECT least(vec_id, nbr) AS a, greatest(vec_id, nbr) AS b, min(dist) AS dist,
sum(weight) - CASE WHEN count(*) = 2 THEN min(weight) * max(weight) ELSE 0 END AS weight FROM directed GROUP BY 1, 2)"""


@query("umap_edges", f"WITH {_FUZZY} SELECT a, b, round(weight, 6) AS weight, round(dist, 6) AS dist FROM edges")
def umap_edges(spark, folder):
    near = cut(neighbours.knn(_vectors(spark, folder), K))
    lengths = near.groupBy(F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b")).agg(
        F.min("dist").alias("dist"))
    return _rounded(neighbours.fuzzy_edges(near).join(lengths, ["a", "b"]), "weight", "dist")


@query("fuzzy_edge_weights", f"WITH {_FUZZY} SELECT a, b, round(weight, 6) AS weight FROM edges")
def fuzzy_edge_weights(spark, folder):
    return _rounded(neighbours.fuzzy_edges(neighbours.knn(_vectors(spark, folder), K)), "weight")


@query("local_radius", f"""WITH {_FUZZY}, e AS (SELECT a AS vec_id, weight, dist FROM edges UNION ALL SELECT b, weight, dist FROM edges)
SELECT vec_id, round(ln(sum(weight * dist * dist) / sum(weight)), 6) AS radius FROM e GROUP BY vec_id""")
def local_radius(spark, folder):
    near = cut(neighbours.knn(_vectors(spark, folder), K))
    lengths = near.groupBy(F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b")).agg(
        F.min("dist").alias("dist"))
    edges = neighbours.fuzzy_edges(near).join(lengths, ["a", "b"])
    return _rounded(neighbours.local_radius(edges), "radius")


# -- clusters ----------------------------------------------------------------------------------------

_CENTRES = f"""{_V}, parts AS (SELECT label, generate_subscripts(z, 1) AS i, unnest(z) AS x FROM v),
means AS (SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i),
centres AS (SELECT label, list(x ORDER BY i) AS centre FROM means GROUP BY label)"""


@query("kmeans_assign", f"""WITH {_CENTRES}, d AS (SELECT vec_id, c.label AS cluster, list_distance(z, centre) AS dist FROM v, centres c)
SELECT vec_id, cluster, round(dist, 6) AS dist FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) = 1""")
def kmeans_assign(spark, folder):
    rows = _vectors(spark, folder)
    placed = vectors.nearest_centre(rows.drop("cluster"), vectors.centroids(rows))
    return _rounded(placed.select("vec_id", "cluster", "dist"), "dist")


@query("davies_bouldin", f"""WITH {_CENTRES}, s AS (SELECT label, avg(list_distance(z, centre)) AS s FROM v JOIN centres USING (label) GROUP BY label),
t AS (SELECT * FROM centres JOIN s USING (label)),
r AS (SELECT a.label, max((a.s + b.s) / list_distance(a.centre, b.centre)) AS worst FROM t a JOIN t b ON a.label <> b.label GROUP BY a.label)
SELECT round(avg(worst), 6) AS davies_bouldin FROM r""")
def davies_bouldin(spark, folder):
    return _rounded(vectors.davies_bouldin(_vectors(spark, folder)), "davies_bouldin")


def _silhouette_sql(power):
    dist = "list_distance(a.z, b.z)" + (" * list_distance(a.z, b.z)" if power == 2 else "")
    return f"""WITH {_V}, c AS (SELECT a.vec_id, a.label AS own, b.label, avg({dist}) AS m
FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY ALL),
s AS (SELECT vec_id, coalesce(max(m) FILTER (own = label), 0) AS a, min(m) FILTER (own <> label) AS b FROM c GROUP BY vec_id)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s"""


@query("silhouette_exact", _silhouette_sql(1))
def silhouette_exact(spark, folder):
    return _rounded(vectors.silhouette(_vectors(spark, folder)), "silhouette")


@query("silhouette_sq", _silhouette_sql(2))
def silhouette_sq(spark, folder):
    return _rounded(vectors.silhouette_squared(_vectors(spark, folder)), "silhouette")


_BISECT = _FUZZY[_FUZZY.index("s AS (WITH"):_FUZZY.index("directed AS")]


@query("layout_transform", f"""WITH {_V}, pairs AS (SELECT a.vec_id, b.vec_id AS nbr, b.z AS xy, list_distance(a.z, b.z) AS dist
FROM v a, v b),
knn AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr) AS rank FROM pairs QUALIFY rank <= {K}),
r AS (SELECT vec_id, min(dist) FILTER (dist > 0) AS rho, list(dist ORDER BY rank) AS ds FROM knn GROUP BY vec_id),
{_BISECT}
w AS (SELECT vec_id, xy, exp(-greatest(0, dist - rho) / sigma) AS weight FROM knn JOIN s USING (vec_id))
SELECT vec_id, round(sum(weight * xy[1]) / sum(weight), 6) + 0.0::DOUBLE AS x,
round(sum(weight * xy[2]) / sum(weight), 6) + 0.0::DOUBLE AS y FROM w GROUP BY vec_id""")
def layout_transform(spark, folder):
    """All rows placed on a layout of the same rows, whose coordinates are given."""
    rows = _vectors(spark, folder)
    coords = rows.select("vec_id", F.slice("z", 1, 2).alias("z"))
    placed = layout.place_new(rows, rows, coords, K)
    return _rounded(placed.select("vec_id", F.get("z", F.lit(0)).alias("x"), F.get("z", F.lit(1)).alias("y")), "x", "y")


@query("mst_edges")
def mst_edges(spark, folder):
    return density.reachability(_planted(spark, folder), MIN_SAMPLES)


EPS = 1.15


@query("dbscan_star", f"""WITH RECURSIVE {_REACH}, near AS (
SELECT p.vec_id, p.nbr FROM pairs p JOIN cores a ON a.vec_id = p.vec_id JOIN cores b ON b.vec_id = p.nbr
WHERE greatest(a.core, b.core, dist) <= {EPS}),
reach AS (SELECT vec_id, vec_id AS seen FROM v UNION SELECT r.vec_id, n.nbr FROM reach r JOIN near n ON n.vec_id = r.seen)
SELECT r.vec_id, CASE WHEN any_value(core) <= {EPS} THEN min(seen) ELSE -1 END AS cluster
FROM reach r JOIN cores c ON c.vec_id = r.vec_id GROUP BY r.vec_id""")
def dbscan_star(spark, folder):
    rows = cut(_vectors(spark, folder))
    near = cut(neighbours.knn(rows, MIN_SAMPLES, spare=spanning.SPARE))
    cores = cut(neighbours.core_distance(near, MIN_SAMPLES))
    return density.flat_cut(rows, spanning.reachability_tree(rows, cores, near=near), cores, EPS)


# by construction the planted groups are the clusters, and the scattered rows the noise
_PLANTED = """planted AS (SELECT vec_id, CASE WHEN vec_id % 17 = 0 THEN -1 ELSE vec_id % 5 END AS g FROM embeddings),
groups AS (SELECT g, count(*) AS n, min(vec_id) AS first FROM planted GROUP BY g),
named AS (SELECT g, row_number() OVER (ORDER BY n DESC, first) - 1 AS cluster FROM groups WHERE g >= 0)"""


@query("hdbscan_labels", f"WITH {_PLANTED} SELECT vec_id, coalesce(cluster, -1) AS cluster FROM planted LEFT JOIN named USING (g)")
def hdbscan_labels(spark, folder):
    return density.hdbscan(_planted(spark, folder), 20)


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    return models.kmeans(_vectors(spark, folder).select("vec_id", "z"), 8)[1].select("vec_id", "cluster")


def _reduced(spark, folder, dims):
    rows = _planted(spark, folder)
    return {d: vectors.random_projection(rows, 64, d) for d in dims}


#: Dimensions, cluster numbers, minimum sizes and epsilons of the grids.
DIMS = list(range(2, 30, 2))
KS = list(range(4, 20))
SIZES = list(range(5, 50, 5))
EPSILONS = [round(0.1 * i, 1) for i in range(10)]


@query("kmeans_grid")
def kmeans_grid(spark, folder):
    """Cluster sizes of k-means for every dimension and k."""
    grid = models.kmeans_grid(_reduced(spark, folder, DIMS), KS)
    return grid.groupBy("d", "k", "cluster").agg(F.count("*").alias("n"))


@query("kmeans_scores")
def kmeans_scores(spark, folder):
    """Silhouette and Davies-Bouldin index of every one of these clusterings."""
    return models.kmeans_scores(_reduced(spark, folder, DIMS), KS)


@query("hdbscan_grid")
def hdbscan_grid(spark, folder):
    """Cluster sizes for every dimension and minimum size, with one core distance for all."""
    grid = models.density_grid(_reduced(spark, folder, DIMS), SIZES, [0.0], min_samples=MIN_SAMPLES)
    return grid.groupBy("d", "m", "eps", "status", "cluster").agg(F.count("vec_id").alias("n"))


@query("epsilon_grid")
def epsilon_grid(spark, folder):
    """The two final candidates over all epsilons; the core distance follows the minimum size."""
    parts = [models.density_grid(_reduced(spark, folder, [d]), [m], EPSILONS) for d, m in ((6, 28), (5, 20))]
    return parts[0].unionByName(parts[1]).groupBy("d", "m", "eps", "status", "cluster").agg(F.count("vec_id").alias("n"))


@query("stability_check", f"WITH {_PLANTED} SELECT string_agg(n, ',' ORDER BY n DESC) AS sizes, 5 AS n_runs FROM groups")
def stability_check(spark, folder):
    rows = cut(_planted(spark, folder))
    return models.same_sizes([density.hdbscan(rows, 20, min_samples=MIN_SAMPLES, epsilon=0.3) for _ in range(5)])


STEPS = 200


@query("umap_layout")
def umap_layout(spark, folder):
    rows = layout.fit(_planted(spark, folder), dim=2, n_neighbors=K, steps=STEPS)
    return rows.select("vec_id", F.get("z", F.lit(0)).alias("x"), F.get("z", F.lit(1)).alias("y"))


@query("density_layout")
def density_layout(spark, folder):
    """Layout that also keeps how dense the surroundings of each row are, beside the radius it has to keep."""
    rows = cut(_planted(spark, folder))
    placed = layout.fit(rows, dim=2, n_neighbors=K, steps=STEPS, density_weight=DENSITY, epochs=20)
    near = cut(neighbours.knn(rows, K))
    pair = [F.least("vec_id", "nbr").alias("a"), F.greatest("vec_id", "nbr").alias("b")]
    edges = neighbours.fuzzy_edges(near).join(near.groupBy(*pair).agg(F.min("dist").alias("dist")), ["a", "b"])
    return placed.join(neighbours.local_radius(edges), "vec_id", "left").select(
        "vec_id", F.get("z", F.lit(0)).alias("x"), F.get("z", F.lit(1)).alias("y"), "radius")


@query("layout_new_rows")
def layout_new_rows(spark, folder):
    """Every fourth row placed on a layout that was fitted without it, and moved there for 100 steps."""
    rows = cut(_planted(spark, folder))
    held = F.pmod(F.xxhash64("vec_id"), F.lit(4)) == 0
    fitted = rows.where(~held)
    coords = cut(layout.fit(fitted, dim=2, n_neighbors=K, steps=STEPS))
    placed = layout.place_new(rows.where(held), fitted, coords, K, steps=100)
    old, new = coords.withColumn("is_new", F.lit(False)), placed.withColumn("is_new", F.lit(True))
    return old.unionByName(new).select("vec_id", "is_new", F.get("z", F.lit(0)).alias("x"), F.get("z", F.lit(1)).alias("y"))


@query("final_model")
def final_model(spark, folder):
    """Layout in five dimensions, then density clusters of at least 20 rows cut at 0.3."""
    rows = cut(layout.fit(_planted(spark, folder), dim=5, n_neighbors=K, steps=STEPS))
    labels = density.hdbscan(rows, 20, epsilon=0.3)
    return labels.join(rows, "vec_id").select("vec_id", "cluster", *vectors.columns("z", 5))


# -- topics --------------------------------------------------------------------------------------------

def _topic_words(spark, folder, terms):
    rows = tok.topic_features(views.texts(spark, folder), CFG)
    vocabulary, model, _ = models.topics(rows, terms)
    top = models.describe_topics(vocabulary, model)
    return top.select(
        "topic", F.array_join("topic_words", "|").alias("topic_words"),
        F.array_join(F.transform("weights", lambda w: F.round(w, 6).cast("string")), "|").alias("weights"))


@query("lda_ngrams")
def lda_ngrams(spark, folder):
    rows = tok.topic_features(views.texts(spark, folder), CFG)
    _, model, docs = models.topics(rows, "ngrams")
    return model.transform(docs).select("id", *vectors.columns("share", 5, "topic"))


@query("lda_emojis")
def lda_emojis(spark, folder):
    return _topic_words(spark, folder, "emojis")


@query("topic_words")
def topic_words(spark, folder):
    return _topic_words(spark, folder, "ngrams")


@query("lda_perplexity")
def lda_perplexity(spark, folder):
    rows = tok.topic_features(views.texts(spark, folder), CFG)
    return models.perplexity(rows, "ngrams", [3, 5])
