"""Queries that summarise posts, chunks, cluster labels, time and code points."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from postlens.functions import text as tx
from postlens.operators import codepoints, grids, stats, timeseries, tokens as tok, vectors
from postlens.operators.joins import lookup_join
from postlens.plans import sql_views as v
from postlens.plans.registry import query
from postlens.plans.text_queries import _chunks, _sentences
from postlens.plans.token_queries import CFG, SENTIMENT
from postlens.session import cut, shared_dir
from postlens.sources import readers, sinks, views

# -- posts -------------------------------------------------------------------------------


@query("id_unique", """SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_keys,
count(*) = count(DISTINCT doc_id) AS is_unique FROM documents""")
def id_unique(spark, folder):
    return stats.key_is_unique(readers.table(spark, folder, "documents"), "doc_id")


@query("top_commented", f"WITH {v.POSTS} SELECT id, comms_num, title FROM posts ORDER BY comms_num DESC, id LIMIT 10")
def top_commented(spark, folder):
    return views.posts(spark, folder).select("id", "comms_num", "title").orderBy(F.desc("comms_num"), "id").limit(10)


@query("max_sentence_no", f"WITH {v.SENTENCES} SELECT id, max(num_s) AS max_sent_num FROM sents GROUP BY id")
def max_sentence_no(spark, folder):
    return _sentences(spark, folder).groupBy("id").agg(F.max("num_s").alias("max_sent_num")).orderBy(
        F.desc("max_sent_num"), "id"
    )


def _chunk_lengths(spark, folder):
    return _chunks(spark, folder).select(F.length("long_sent").alias("len"))


_LENGTHS = f"{v.CHUNKS}, lens AS (SELECT length(long_sent) AS len FROM chunks)"


@query("length_describe", f"""WITH {_LENGTHS} SELECT count(*) AS n_rows, round(avg(len), 6) AS mean,
round(stddev_samp(len), 4) AS std, min(len) AS min, quantile_cont(len, 0.25) AS p25,
quantile_cont(len, 0.5) AS p50, quantile_cont(len, 0.75) AS p75, max(len) AS max FROM lens""")
def length_describe(spark, folder):
    return stats.describe(_chunk_lengths(spark, folder), "len")


def _histogram(name, low, high, bins):
    width = (high - low) / bins

    def run(spark, folder):
        return stats.histogram(_chunk_lengths(spark, folder), "len", low, high, bins)

    query(name, f"""WITH {_LENGTHS} SELECT CAST(least(floor((len - {low}) / {width}::DOUBLE), {bins - 1}) AS BIGINT) AS bin,
count(*) AS n FROM lens WHERE len BETWEEN {low} AND {high} GROUP BY 1""")(run)


_histogram("length_histogram", 0, 1000, 100)
_histogram("length_histogram_short", 0, 200, 100)


@query("sentence_count_kde", f"""WITH {v.SENTENCES}, c AS (SELECT id, max(num_s)::DOUBLE AS v FROM sents GROUP BY id),
f AS (SELECT count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM c),
g AS (SELECT point, lo - (hi - lo) / 2 + point * ((hi - lo) * 2 / 99) AS x FROM f, (SELECT unnest(range(100)) AS point))
SELECT point, round(any_value(x), 6) AS x,
round(sum(exp(-((x - v) / h) * ((x - v) / h) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM g, c, f GROUP BY point""")
def sentence_count_kde(spark, folder):
    counts = _sentences(spark, folder).groupBy("id").agg(F.max("num_s").alias("v"))
    return stats.density(counts, "v")


@query("batch_count", f"""WITH {v.CHUNKS} SELECT count(*) AS n_rows, CAST(ceil(count(*) / 32) AS BIGINT) AS n_batches
FROM chunks WHERE length(long_sent) > 100""")
def batch_count(spark, folder):
    return stats.batches(_chunks(spark, folder).where(F.length("long_sent") > 100))


# -- cluster labels --------------------------------------------------------------------------

GRID = [(5, 20), (5, 28), (6, 20), (6, 28), (8, 40), (12, 28)]


def _labels(spark, folder):
    rows = readers.table(spark, folder, "embeddings")
    return rows.select("vec_id", F.col("label").alias("cluster"))


def _grid(spark, folder):
    """Given labels per parameter pair, derived from the label column."""
    pairs = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(m).alias("m")) for d, m in GRID])
    rows = _labels(spark, folder).withColumn("p", F.explode(pairs))
    return rows.select(
        F.col("p.d").alias("d"), F.col("p.m").alias("m"), "vec_id",
        ((F.col("vec_id") * F.col("p.m") + F.col("cluster")) % (F.col("p.d") + 3) - 1).alias("cluster"),
    )


def _grid_sizes(spark, folder):
    return _grid(spark, folder).groupBy("d", "m", "cluster").agg(F.count("*").alias("n"))


_PAIRS = ", ".join(f"({d}, {m})" for d, m in GRID)
_GRID = f"""grid AS (SELECT d, m, vec_id, (vec_id * m + label) % (d + 3) - 1 AS cluster
FROM embeddings, (VALUES {_PAIRS}) AS p(d, m)),
sizes AS (SELECT d, m, cluster, count(*) AS n FROM grid GROUP BY d, m, cluster),
ranked AS (SELECT *, row_number() OVER (PARTITION BY d, m ORDER BY n DESC, cluster) AS rank FROM sizes)"""


@query("cluster_sizes", "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY label")
def cluster_sizes(spark, folder):
    return stats.value_counts(_labels(spark, folder), "cluster").orderBy(F.desc("n"), "cluster")


@query("cluster_sizes_wide", "SELECT " + ", ".join(
    f"count(*) FILTER (label = {c}) AS c{c}" for c in range(10)) + " FROM embeddings")
def cluster_sizes_wide(spark, folder):
    return stats.wide_counts(stats.value_counts(_labels(spark, folder), "cluster"), "cluster")


@query("label_count", f"WITH {_GRID} SELECT d, m, count(*) AS num_clusters FROM sizes GROUP BY d, m")
def label_count(spark, folder):
    return _grid_sizes(spark, folder).groupBy("d", "m").agg(F.count("*").alias("num_clusters"))


_DOMINANT = """dominant AS (SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY label HAVING count(*) > 49)"""


@query("dominant_clusters", f"""WITH {_DOMINANT} SELECT cluster, n,
round(n / (SELECT count(*) FROM embeddings), 6) AS share FROM dominant""")
def dominant_clusters(spark, folder):
    return stats.dominant(_labels(spark, folder), "cluster", 49)


@query("dominant_cluster_rows", f"""WITH {_DOMINANT} SELECT vec_id, label AS cluster FROM embeddings
WHERE label IN (SELECT cluster FROM dominant)""")
def dominant_cluster_rows(spark, folder):
    rows = _labels(spark, folder)
    keep = stats.dominant(rows, "cluster", 49).select("cluster")
    return lookup_join(rows, keep, ["cluster"], "left_semi")


@query("noise_share", f"""WITH {_GRID} SELECT count(*) AS n_rows, count(*) FILTER (cluster = -1) AS n_noise,
round(avg(CAST(cluster = -1 AS INT)), 6) AS noise_share FROM grid""")
def noise_share(spark, folder):
    return stats.noise_share(_grid(spark, folder), "cluster")


@query("size_lists", f"""WITH {_GRID} SELECT d, m, string_agg(n, ',' ORDER BY rank) AS sizes FROM ranked
WHERE rank > 1 AND rank <= 21 GROUP BY d, m""")
def size_lists(spark, folder):
    return stats.size_lists(_grid_sizes(spark, folder), ["d", "m"], head=20, skip=1)


@query("pick_model_minmax", f"""WITH {_GRID}, g AS (SELECT d, m, count(*) AS num_clusters, max(n) AS largest
FROM sizes GROUP BY d, m HAVING count(*) > 5 AND count(*) < 13)
SELECT * FROM g WHERE largest = (SELECT min(largest) FROM g)""")
def pick_model_minmax(spark, folder):
    return stats.pick_smallest_maximum(_grid_sizes(spark, folder), ["d", "m"], 5, 13)


@query("pick_model_nth", f"""WITH {_GRID} SELECT d, m, string_agg(n, ',' ORDER BY rank) AS sizes FROM ranked
WHERE rank <= 10 AND (d, m) IN (SELECT (d, m) FROM ranked WHERE rank = 6 AND n > 40) GROUP BY d, m""")
def pick_model_nth(spark, folder):
    return stats.pick_by_nth_largest(_grid_sizes(spark, folder), ["d", "m"], nth=6, at_least=40)


#: Dimensions and cluster numbers of the scored labellings, which are derived from the labels.
SCORE_DIMS, SCORE_KS = (2, 5, 6, 8), (4, 5, 6, 7, 9)
_SCORES = "scored AS (" + " UNION ALL ".join(f"""SELECT {d} AS d, k, silhouette, db FROM (
WITH v AS MATERIALIZED (SELECT vec_id, label, embedding[1:{d}]::DOUBLE[] AS z FROM embeddings),
c AS (SELECT k, vec_id, (own * 3 + vec_id % 2) % k AS own, (label * 3 + other % 2) % k AS label, avg(dist) AS m
    FROM (SELECT a.vec_id, b.vec_id AS other, a.label AS own, b.label, list_distance(a.z, b.z) AS dist FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    (SELECT unnest({list(SCORE_KS)}) AS k) GROUP BY k, vec_id, 3, 4),
s AS (SELECT k, vec_id, max(m) FILTER (own = label) AS a, min(m) FILTER (own <> label) AS b FROM c GROUP BY k, vec_id),
t AS (SELECT k, avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM s GROUP BY k),
g AS (SELECT k, (label * 3 + vec_id % 2) % k AS label, z FROM v, (SELECT unnest({list(SCORE_KS)}) AS k)),
p AS (SELECT k, label, generate_subscripts(z, 1) AS i, unnest(z) AS x FROM g),
mean AS (SELECT k, label, i, avg(x) AS x FROM p GROUP BY k, label, i),
centre AS (SELECT k, label, list(x ORDER BY i) AS centre FROM mean GROUP BY k, label),
spread AS (SELECT k, label, any_value(centre) AS centre, avg(list_distance(z, centre)) AS s FROM g JOIN centre USING (k, label) GROUP BY k, label),
r AS (SELECT a.k, a.label, max((a.s + b.s) / list_distance(a.centre, b.centre)) AS worst FROM spread a JOIN spread b ON a.k = b.k AND a.label <> b.label GROUP BY a.k, a.label)
SELECT t.k, silhouette, db FROM t JOIN (SELECT k, avg(worst) AS db FROM r GROUP BY k) USING (k))""" for d in SCORE_DIMS) + ")"


def _given_scores(spark, folder):
    """Silhouette and Davies-Bouldin index of given labellings in the first components."""
    rows = readers.table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    labels = F.array(*[((F.col("label") * 3 + F.col("vec_id") % 2) % k).cast("int") for k in SCORE_KS])
    out = None
    for d in SCORE_DIMS:
        z = F.transform(F.slice("embedding", 1, d), lambda x: x.cast("double"))
        names = spark.createDataFrame([(g, d, k) for g, k in enumerate(SCORE_KS)], "g int, d int, k int")
        part = grids.scores(rows.select("vec_id", z.alias("z"), labels.alias("labels")), names)
        out = part if out is None else out.unionByName(part)
    return out.select("d", "k", F.round("silhouette", 9).alias("silhouette"), F.round("db", 9).alias("db"))


@query("score_grid", f"WITH {_SCORES} SELECT d, k, round(silhouette, 9) AS silhouette, round(db, 9) AS db FROM scored")
def score_grid(spark, folder):
    return _given_scores(spark, folder)


@query("score_table", f"""WITH {_SCORES}, s AS (SELECT d, k, round(silhouette, 9) AS silhouette, round(db, 9) AS db FROM scored)
(SELECT 'silhouette' AS metric, d, k, silhouette AS value FROM s ORDER BY silhouette DESC, d, k LIMIT 1)
UNION ALL (SELECT 'davies_bouldin', d, k, db FROM s ORDER BY db, d, k LIMIT 1)""")
def score_table(spark, folder):
    return stats.best_scores(_given_scores(spark, folder))


# -- joining results back -----------------------------------------------------------------------

_CLUSTER_OF_CHUNK = "('0x' || substr(md5(concat(post_id, '_', chunk_num)), 1, 4))::BIGINT % 9 - 1"
_CLUSTERED = f"clustered AS (SELECT post_id, chunk_num, {_CLUSTER_OF_CHUNK} AS cluster FROM chunks WHERE length(long_sent) > 100)"


def _clustered(chunks):
    """Given labels for the kept chunks."""
    key = F.md5(F.concat_ws("_", "post_id", "chunk_num"))
    label = F.conv(F.substring(key, 1, 4), 16, 10).cast("bigint") % 9 - 1
    return chunks.where(F.length("long_sent") > 100).select("post_id", "chunk_num", label.alias("cluster"))


@query("attach_cluster_text", f"""WITH {v.CHUNKS}, {_CLUSTERED} SELECT post_id, chunk_num, cluster, long_sent
FROM clustered JOIN chunks USING (post_id, chunk_num)""")
def attach_cluster_text(spark, folder):
    chunks = cut(_chunks(spark, folder))
    return _clustered(chunks).join(chunks, ["post_id", "chunk_num"])


@query("assemble_result", "SELECT vec_id, label AS cluster, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS z{i}" for i in range(64)) + ", " + ", ".join(
    "round((" + " + ".join(f"{int(s)} * embedding[{i + 1}]::DOUBLE" for i, s in enumerate(row)) + f") / sqrt(2), 6) + 0.0::DOUBLE AS {name}"
    for name, row in zip("xy", vectors.projection_signs(64, 2))) + " FROM embeddings")
def assemble_result(spark, folder):
    """Labels beside all components of the vectors and their place in the plane."""
    z = F.transform("embedding", lambda x: x.cast("double"))
    rows = readers.table(spark, folder, "embeddings").select("vec_id", z.alias("z"))
    plane = vectors.random_projection(rows, 64, 2)
    xy = [(F.round(F.get("z", F.lit(i)), 6) + 0.0).alias(name) for i, name in enumerate("xy")]
    return _labels(spark, folder).join(rows.select("vec_id", *vectors.columns("z", 64)), "vec_id").join(
        plane.select("vec_id", *xy), "vec_id")


@query("reconcile_keys", f"""WITH {v.CHUNKS}, {_CLUSTERED}, u AS (
SELECT post_id, chunk_num, 1 AS n FROM chunks UNION ALL SELECT post_id, chunk_num, -1 FROM clustered)
SELECT post_id, chunk_num, CAST(sum(n) AS BIGINT) AS surplus FROM u GROUP BY 1, 2 HAVING sum(n) <> 0""")
def reconcile_keys(spark, folder):
    chunks = cut(_chunks(spark, folder))
    return stats.key_differences(chunks, _clustered(chunks), ["post_id", "chunk_num"])


@query("reconcile_counts", f"""WITH {v.CHUNKS}, {_CLUSTERED}, c AS (SELECT (SELECT count(*) FROM chunks) AS n_left,
(SELECT count(*) FROM clustered) AS n_right) SELECT n_left, n_right, n_left = n_right AS equal FROM c""")
def reconcile_counts(spark, folder):
    chunks = cut(_chunks(spark, folder))
    return stats.compare_counts(chunks, _clustered(chunks))


@query("vector_equal", """SELECT a.vec_id, a.embedding = a.embedding AS same_self, a.embedding = b.embedding AS same_next
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_equal(spark, folder):
    rows = readers.table(spark, folder, "embeddings").select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return rows.join(following, "vec_id").select(
        "vec_id",
        stats.same_vectors(F.col("embedding"), F.col("embedding")).alias("same_self"),
        stats.same_vectors(F.col("embedding"), F.col("next")).alias("same_next"),
    )


@query("row_concat", """SELECT 'documents' AS origin, doc_id AS id, length(text) AS n_chars FROM documents
UNION ALL SELECT 'conversations', conv_id, length(text) FROM conversations""")
def row_concat(spark, folder):
    docs = readers.table(spark, folder, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), F.length("text").alias("n_chars"))
    turns = readers.table(spark, folder, "conversations").select(
        F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), F.length("text").alias("n_chars"))
    return docs.unionByName(turns)


@query("combined_view_sql", f"""WITH {v.CHUNKS} SELECT post_id, chunk_num, length(long_sent) AS len FROM chunks""")
def combined_view_sql(spark, folder):
    """The same rows through a named view and SQL text."""
    name = "long_sents"
    _chunks(spark, folder).createOrReplaceTempView(name)
    return spark.sql(f"SELECT post_id, chunk_num, LENGTH(long_sent) AS len FROM {name}")


# -- stage outputs written and read back ---------------------------------------------------------

def _new_path(spark, name):
    return sinks.run_folder(shared_dir(spark), name, uuid.uuid4().hex)


@query("saved_labels", f"WITH {_GRID} SELECT d, m, vec_id, cluster FROM grid WHERE d = 6 AND m = 28")
def saved_labels(spark, folder):
    """Labels of all parameter pairs in one table; reading one pair opens one folder."""
    path = _new_path(spark, "labels")
    sinks.write_params(_grid(spark, folder), path, ["d", "m"])
    return readers.read_params(spark, path, d=6, m=28).select("d", "m", "vec_id", "cluster")


@query("saved_sizes_csv", f"""WITH {_GRID} SELECT d, m, count(*) AS clusters, CAST(sum(n) AS BIGINT) AS n,
CAST(sum(n * cluster) AS BIGINT) AS weighted, 1 AS files FROM sizes GROUP BY d, m""")
def saved_sizes_csv(spark, folder):
    """Sizes of all clusters through a single CSV file: sums of each model, and the files they came from."""
    path = _new_path(spark, "sizes")
    sinks.write_csv(_grid_sizes(spark, folder).select("d", "m", "cluster", "n"), path, single_file=True)
    back = readers.read_csv(spark, path, "d bigint, m bigint, cluster bigint, n bigint", multiline=False, glob="part*")
    return back.withColumn("file", F.input_file_name()).groupBy("d", "m").agg(
        F.count("*").alias("clusters"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("cluster")).alias("weighted"),
        F.count_distinct("file").alias("files"))


@query("saved_runs_glob", """SELECT 'documents' AS origin, doc_id AS id, length(text) AS n_chars FROM documents
UNION ALL SELECT 'conversations', conv_id, length(text) FROM conversations""")
def saved_runs_glob(spark, folder):
    """Part files of two runs, each in a folder of its own, read as one table by a pattern."""
    base = _new_path(spark, "runs")
    for name, key in (("documents", "doc_id"), ("conversations", "conv_id")):
        rows = readers.table(spark, folder, name).select(
            F.lit(name).alias("origin"), F.col(key).alias("id"), F.length("text").alias("n_chars"))
        sinks.write_csv(rows, sinks.run_folder(base, "lengths", name), sep="\t")
    schema = "origin string, id bigint, n_chars bigint"
    return readers.read_csv(spark, f"{base}/lengths_*", schema, sep="\t", multiline=False, glob="part*")


@query("saved_sizes_json", f"WITH {_GRID} SELECT d, m, cluster, n FROM sizes")
def saved_sizes_json(spark, folder):
    path = _new_path(spark, "sizes")
    sinks.write_scores(_grid_sizes(spark, folder), path)
    return spark.read.schema("d long, m long, cluster long, n long").json(path)


@query("saved_chunks_tsv", f"""WITH {v.CHUNKS}, {_CLUSTERED} SELECT post_id, chunk_num, cluster, long_sent
FROM clustered JOIN chunks USING (post_id, chunk_num)""")
def saved_chunks_tsv(spark, folder):
    """Chunks go out as tab-separated text and labels as comma-separated; both are read back and joined."""
    chunks = cut(_chunks(spark, folder))
    chunk_path, label_path = _new_path(spark, "sentences"), _new_path(spark, "clustered")
    sinks.write_csv(chunks, chunk_path, sep="\t")
    sinks.write_csv(_clustered(chunks), label_path)
    texts = readers.read_csv(spark, chunk_path, "post_id long, chunk_num long, long_sent string", sep="\t", glob="part*")
    labels = readers.read_csv(spark, label_path, "post_id long, chunk_num long, cluster long", multiline=False, glob="part*")
    return labels.join(texts, ["post_id", "chunk_num"])


# -- time -------------------------------------------------------------------------------------

def _shown(df):
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


def _buckets_sql(value):
    return f"""WITH {v.POSTS}, b AS (SELECT time_bucket(INTERVAL '3 hours', timestamp) AS bucket, {value} AS n FROM posts GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(bucket) FROM b), (SELECT max(bucket) FROM b), INTERVAL '3 hours')) AS bucket)
SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, coalesce(n, 0) AS n FROM g LEFT JOIN b USING (bucket)"""


@query("posts_3h", _buckets_sql("count(*)"))
def posts_3h(spark, folder):
    return _shown(timeseries.resample(views.post_activity(spark, folder), "timestamp", F.count("*")))


@query("comments_3h", _buckets_sql("CAST(sum(comms_num) AS BIGINT)"))
def comments_3h(spark, folder):
    return _shown(timeseries.resample(views.post_activity(spark, folder), "timestamp", F.sum("comms_num")))


_BINS = f"""{v.POSTS}, us AS (SELECT id, epoch_us(timestamp) AS us FROM posts),
bins AS (SELECT id, CAST(greatest(0, ceil((us - (SELECT min(us) FROM us)) * 240 /
((SELECT max(us) FROM us) - (SELECT min(us) FROM us))) - 1) AS BIGINT) AS bin FROM us)"""


@query("time_bins", f"WITH {_BINS} SELECT id, bin FROM bins")
def time_bins(spark, folder):
    return timeseries.time_bins(views.post_activity(spark, folder), "timestamp", 240).select("id", "bin")


@query("sparse_bins", f"""WITH {_BINS}, g AS (SELECT unnest(range(240)) AS bin)
SELECT g.bin, count(id) AS n FROM g LEFT JOIN bins USING (bin) GROUP BY g.bin HAVING count(id) < 5""")
def sparse_bins(spark, folder):
    binned = timeseries.time_bins(views.post_activity(spark, folder), "timestamp", 240)
    return timeseries.sparse_bins(binned, 240, below=5)


@query("bin_occupancy", f"""WITH {_BINS}, c AS (SELECT bin, count(*) AS n FROM bins GROUP BY bin)
SELECT count(*) AS n_rows, round(avg(n), 6) AS mean, round(stddev_samp(n), 4) AS std, min(n) AS min,
quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, max(n) AS max FROM c""")
def bin_occupancy(spark, folder):
    binned = timeseries.time_bins(views.post_activity(spark, folder), "timestamp", 240)
    counts = binned.groupBy("bin").agg(F.count("*").alias("size"))
    return stats.describe(counts, "size")


def _shares_sql(source, label):
    return f"""c AS (SELECT strftime(time_bucket(INTERVAL '1 day', timestamp), '%Y-%m-%d %H:%M:%S') AS bucket,
{label}, count(*) AS n FROM {source} GROUP BY 1, 2)
SELECT bucket, {label}, n, round(n / sum(n) OVER (PARTITION BY bucket), 6) AS share FROM c"""


@query("topic_evolution", f"""WITH {v.POSTS}, t AS (SELECT p.timestamp, d.source AS topic FROM posts p
JOIN documents d ON d.doc_id = p.id), {_shares_sql('t', 'topic')}""")
def topic_evolution(spark, folder):
    topics = readers.table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("topic"))
    rows = views.post_activity(spark, folder).join(topics, "id")
    return _shown(timeseries.shares(rows, "timestamp", "topic"))


@query("sentiment_evolution", f"""WITH {v.POSTS_AND_TEXTS}, {SENTIMENT}, t AS (
SELECT p.timestamp, s.sentiment_class FROM sentiment s JOIN posts p USING (id)), {_shares_sql('t', 'sentiment_class')}""")
def sentiment_evolution(spark, folder):
    classes = tok.sentiment_rows(views.texts(spark, folder), CFG).select("id", "sentiment_class")
    rows = classes.join(views.post_activity(spark, folder), "id")
    return _shown(timeseries.shares(rows, "timestamp", "sentiment_class"))


# -- code points ------------------------------------------------------------------------------

_RANGES = f"""{v.TEXTS}, cps AS (SELECT DISTINCT unicode(c) AS cp
FROM (SELECT unnest(regexp_extract_all(text, '[\\s\\S]')) AS c FROM texts)),
isl AS (SELECT cp, cp - row_number() OVER (ORDER BY cp) AS island FROM cps),
ranges AS (SELECT min(cp) AS first, max(cp) AS last, max(cp) - min(cp) + 1 AS size FROM isl GROUP BY island)"""


def _ranges(spark, folder):
    return codepoints.ranges(codepoints.distinct_codes(views.texts(spark, folder)))


@query("codepoint_ranges", f"WITH {_RANGES} SELECT first, last, size FROM ranges")
def codepoint_ranges(spark, folder):
    return _ranges(spark, folder)


@query("large_ranges", f"WITH {_RANGES} SELECT first, last, size FROM ranges WHERE size >= 20")
def large_ranges(spark, folder):
    return codepoints.large(_ranges(spark, folder))


@query("isolated_codepoints", f"""WITH {_RANGES}, c AS (SELECT unnest(range(first, last + 1)) AS cp FROM ranges WHERE size < 20)
SELECT cp, lower(hex(cp)) AS hex FROM c""")
def isolated_codepoints(spark, folder):
    return codepoints.isolated(_ranges(spark, folder))


@query("range_regex", f"""WITH {_RANGES} SELECT concat('[', string_agg(concat('\\x{{', lower(hex(first)), '}}-\\x{{',
lower(hex(last)), '}}'), '' ORDER BY first), ']') AS regex_class FROM ranges""")
def range_regex(spark, folder):
    return codepoints.regex_class(_ranges(spark, folder))


_SEQUENCES = f"""{v.TEXTS}, e AS (SELECT DISTINCT unnest({v.extract('text', tx.EMOJI_SEQUENCE_RE)}) AS emoji FROM texts),
q AS (SELECT emoji, list_transform(regexp_extract_all(emoji, '[\\s\\S]'), lambda c: upper(hex(unicode(c)))) AS codes FROM e),
seqs AS (SELECT emoji, codes, len(codes) AS n_codes, array_to_string(codes, ' ') AS code_text FROM q)"""


def _sequences(spark, folder):
    return codepoints.sequences(views.texts(spark, folder))


@query("hex_codepoints", f"WITH {_SEQUENCES} SELECT emoji, code_text, n_codes FROM seqs")
def hex_codepoints(spark, folder):
    return _sequences(spark, folder).select("emoji", F.array_join("codes", " ").alias("code_text"), "n_codes")


@query("sequence_lengths", f"""WITH {_SEQUENCES} SELECT least(n_codes, 3) AS code_group, count(*) AS n,
arg_max(code_text, struct_pack(n := n_codes, t := code_text)) AS longest FROM seqs GROUP BY 1""")
def sequence_lengths(spark, folder):
    return codepoints.sequence_lengths(_sequences(spark, folder))


@query("sequence_delta", f"""WITH {_SEQUENCES}, l AS (SELECT code_text, codes, lag(codes) OVER (ORDER BY code_text) AS b
FROM seqs WHERE n_codes > 1)
SELECT code_text, array_to_string(CASE WHEN len(codes) = len(coalesce(b, [])) THEN
list_transform(codes, lambda c, i: CASE WHEN c = b[i] THEN '' ELSE c END) ELSE codes END, ',') AS delta FROM l""")
def sequence_delta(spark, folder):
    return codepoints.sequence_delta(_sequences(spark, folder))
