"""Queries over raw and cleaned post text."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from postlens.functions import text as tx, tokens as tk
from postlens.operators import chunks, codepoints, ordering, rules, stats, tokens as tok
from postlens.plans import sql_views as v
from postlens.plans.registry import query
from postlens.session import shared_dir
from postlens.sources import multiline, readers, sinks, views

SLANG = [("🚀+", "🚀"), ("(?:💎🙌)+", "💎"), ("game stop", "GME")]
RULES = [(tx.EMOJI_RE, "emojis"), (r"\$[0-9]+", "price"), (r"[A-Z]{3,}", "ticker")]
RUN_EMOJIS = ["🚀", "💎", "🙌"]


def text_query(name, expr, sql, column="text"):
    """A query that maps every decorated text to one new column."""
    def run(spark, folder):
        return views.texts(spark, folder).select("id", expr(F.col("text")).alias(column))
    query(name, f"WITH {v.TEXTS} SELECT id, {sql} AS {column} FROM texts")(run)


def joined(array, sep="|"):
    return F.array_join(array, sep)


# -- views and scans ---------------------------------------------------------------

@query("posts", f"""WITH {v.POSTS} SELECT id, title, body, comms_num, url,
strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts FROM posts""")
def posts(spark, folder):
    return views.posts(spark, folder).select(
        "id", "title", "body", "comms_num", "url",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )


def _round_trip(spark, folder, sep, read=readers.read_csv):
    path = os.path.join(shared_dir(spark), f"csv-{uuid.uuid4().hex}")
    rows = views.titles(spark, folder).withColumn("text", F.concat_ws(". ", "title", "body"))
    rows = rows.withColumn("text", F.concat("text", views.decoration(F.col("id"))))
    sinks.write_csv(rows, path, sep=sep)
    return read(spark, path, "id bigint, title string, body string, text string", sep=sep, glob="part*")


_ROUND_TRIP = f"WITH {v.TEXTS} SELECT id, title, body, text FROM titles JOIN texts USING (id)"


@query("csv_scan_roundtrip", _ROUND_TRIP)
def csv_scan_roundtrip(spark, folder):
    return _round_trip(spark, folder, ",")


@query("tsv_scan_roundtrip", _ROUND_TRIP)
def tsv_scan_roundtrip(spark, folder):
    return _round_trip(spark, folder, "\t")


@query("csv_split_roundtrip", _ROUND_TRIP)
def csv_split_roundtrip(spark, folder):
    """The same rows through the reader that cuts a file with line breaks in its fields into many tasks."""
    return _round_trip(spark, folder, ",", multiline.read_csv)


@query("typed_scan_defaults", f"""WITH {v.TITLES} SELECT id, title, coalesce(body, '') AS body,
md5(concat(id, '_7')) AS shuffle_key FROM titles""")
def typed_scan_defaults(spark, folder):
    rows = readers.with_defaults(views.titles(spark, folder), {"title": "", "body": ""})
    return rows.withColumn("shuffle_key", readers.seeded_order(F.col("id"), 7)).orderBy("shuffle_key")


@query("lemma_dictionary", f"""WITH {v.TITLES}, l AS (
SELECT concat(split_part(title, ' ', 1), '->', replace(title, ' ', chr(9))) AS value FROM titles),
p AS (SELECT trim(split_part(value, '->', 1)) AS lemma,
             unnest(string_split(substr(value, strpos(value, '->') + 2), chr(9))) AS form
      FROM l WHERE contains(value, '->'))
SELECT trim(form) AS form, lemma FROM p WHERE trim(form) <> ''""")
def lemma_dictionary(spark, folder):
    line = F.concat(F.substring_index("title", " ", 1), F.lit("->"), F.translate("title", " ", "\t"))
    return readers.lemma_lines(views.titles(spark, folder).select(line.alias("value")))


@query("html_link_texts", """WITH a AS (
SELECT page_id, regexp_extract_all(html, '<a [^>]*>([^<]*)</a>', 1) AS links FROM pages),
l AS (SELECT page_id, generate_subscripts(links, 1) - 1 AS link_no, unnest(links) AS link_text FROM a)
SELECT page_id, link_no, link_text,
       len(list_filter(regexp_split_to_array(link_text, '\\s+'), lambda e: e <> '')) AS n_parts
FROM l""")
def html_link_texts(spark, folder):
    return readers.link_texts(readers.table(spark, folder, "pages"))


# -- projections, filters, samples -----------------------------------------------------

@query("post_text", f"WITH {v.TITLES} SELECT id, concat_ws('. ', title, body) AS text FROM titles")
def post_text(spark, folder):
    return views.titles(spark, folder).select("id", tx.post_text().alias("text"))


text_query("text_length", F.length, "length(text)", "n_chars")


@query("long_posts", f"WITH {v.TEXTS} SELECT id, length(text) AS length FROM texts WHERE length(text) > 100")
def long_posts(spark, folder):
    return views.texts(spark, folder).select("id", F.length("text").alias("length")).where("length > 100")


@query("short_posts", f"WITH {v.TEXTS} SELECT id, length(text) AS length FROM texts WHERE length(text) < 100")
def short_posts(spark, folder):
    return views.texts(spark, folder).select("id", F.length("text").alias("length")).where("length < 100")


@query("null_audit", f"""WITH {v.POSTS} SELECT count(*) AS n_rows, count_if(timestamp IS NULL) AS null_timestamps,
count_if(body IS NULL) AS null_bodies FROM posts""")
def null_audit(spark, folder):
    return views.posts(spark, folder).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("timestamp").isNull()).alias("null_timestamps"),
        F.count_if(F.col("body").isNull()).alias("null_bodies"),
    )


@query("hash_sample", f"""WITH {v.TEXTS} SELECT id, text FROM texts
WHERE ('0x' || substr(md5(concat(id, '_1')), 1, 8))::BIGINT < 858993459""")
def hash_sample(spark, folder):
    return stats.hash_sample(views.texts(spark, folder), "id", 0.2)


@query("fixed_sample", """SELECT vec_id, label FROM embeddings ORDER BY md5(concat(vec_id, '_1')), vec_id LIMIT 200""")
def fixed_sample(spark, folder):
    rows = readers.table(spark, folder, "embeddings").select("vec_id", "label")
    return stats.fixed_sample(rows, "vec_id", 200)


@query("first_rows", f"WITH {v.CHUNKS} SELECT * FROM chunks ORDER BY post_id, chunk_num LIMIT 2000")
def first_rows(spark, folder):
    return _chunks(spark, folder).orderBy("post_id", "chunk_num").limit(2000)


@query("equal_slices", f"""WITH {v.POSTS}, n AS (
SELECT id, row_number() OVER (ORDER BY timestamp, id) - 1 AS position, count(*) OVER () // 24 AS size FROM posts)
SELECT id, position, position // size AS slice_no FROM n WHERE position // size < 24""")
def equal_slices(spark, folder):
    rows = views.post_activity(spark, folder).select("id", "timestamp")
    return ordering.equal_slices(rows, ["timestamp", "id"], 24).select("id", "position", "slice_no")


@query("first_sentence", f"""WITH {v.TEXTS} SELECT id, {v.sentences(v.keep(v.for_embedding('text')))}[1] AS first_sentence,
'0' AS sentence FROM texts""")
def first_sentence(spark, folder):
    rows = tok.sentence_arrays(views.texts(spark, folder)).withColumn("annotated", F.transform("sentences", lambda x, i: F.struct(
        x.alias("result"), F.create_map(F.lit("sentence"), i.cast("string")).alias("metadata"))))
    first = F.get("annotated", F.lit(0))
    return rows.select(
        "id", first["result"].alias("first_sentence"), F.element_at(first["metadata"], "sentence").alias("sentence"))


@query("vector_to_columns", "SELECT vec_id, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS z{i}" for i in range(64)) + " FROM embeddings")
def vector_to_columns(spark, folder):
    rows = readers.table(spark, folder, "embeddings")
    return rows.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"z{i}") for i in range(64)])


# -- cleaning -----------------------------------------------------------------------------

text_query("strip_emojis", tx.strip_emojis, v.replace("text", v.EMOJI, " "))
text_query("extract_emojis", lambda t: joined(tx.extract_emojis(t)),
           f"array_to_string({v.extract('text', v.EMOJI)}, '|')", "emojis")
text_query("straighten_quotes", tx.straighten_quotes, v.straighten("text"))
text_query("strip_links", tx.strip_links, v.strip_links("text"))
text_query("break_to_stop", tx.break_to_stop, v.break_to_stop("text"))
text_query("clean_for_embedding", tx.clean_for_embedding, v.for_embedding("text"))
text_query("clean_for_topics", tx.clean_for_topics, v.for_topics("text"), "text_no_emojis")
text_query("keep_list_normalise", tx.keep_list_for_topics, v.keep_for_topics("text"))
text_query("strip_skin_tone", tx.strip_skin_tone, v.replace("text", tx.SKIN_TONE_RE, ""))
text_query("space_count", tx.count_spaces, "length(text) - length(replace(text, ' ', ''))", "n_spaces")


def _fold(x, rules):
    for pattern, by in rules:
        x = v.replace(x, pattern, by)
    return x


text_query("collapse_emoji_runs", lambda t: tx.collapse_runs(t, RUN_EMOJIS),
           _fold("text", [(f"(?:{e}\\s*){{2,}}", e) for e in RUN_EMOJIS]))
text_query("slang_replace", lambda t: tx.replace_literals(t, SLANG), _fold("text", SLANG))
_flat = v.replace("""replace(text, '\\"', '"')""", r"\s+", " ")
_flat = f"trim({v.replace(v.replace(_flat, '([^ ]{40})', chr(92) + '1 '), ' +', ' ')})"
text_query("wrap_text", tx.wrap,
           f"regexp_replace({v.replace(_flat, '([^' + chr(92) + 'n]{1,40})( |$)', chr(92) + '1<br>')}, '<br>$', '')")


@query("token_cleanup", f"""WITH {v.TOKENS} SELECT id, pos, lower(regexp_replace(token, '[^0-9A-Za-z$&%=]', '', 'g')) AS token
FROM tokens WHERE regexp_replace(token, '[^0-9A-Za-z$&%=]', '', 'g') <> ''""")
def token_cleanup(spark, folder):
    return tok.clean_token_rows(views.texts(spark, folder), tok.TopicConfig())


@query("char_diff", f"""WITH {v.TEXTS}, c AS (
SELECT id, regexp_extract_all(text, '[\\s\\S]') AS a, regexp_extract_all({v.straighten('text')}, '[\\s\\S]') AS b FROM texts),
p AS (SELECT id, generate_subscripts(a, 1) - 1 AS position, unnest(a) AS a, unnest(b) AS b FROM c)
SELECT id, position, upper(hex(unicode(a))) AS left_code, upper(hex(unicode(b))) AS right_code FROM p WHERE a <> b""")
def char_diff(spark, folder):
    rows = views.texts(spark, folder).withColumn("straight", tx.straighten_quotes("text"))
    return codepoints.char_differences(rows, "text", "straight")


@query("url_id_check", f"""WITH {v.POSTS}, u AS (
SELECT id, regexp_extract(url, 'comments/(\\w{{6}})/', 1) AS key FROM posts)
SELECT id, key, key = lpad(CAST(id AS VARCHAR), 6, '0') AS is_id FROM u""")
def url_id_check(spark, folder):
    key = tx.url_key("url", "comments/")
    rows = views.posts(spark, folder).select("id", key.alias("key"))
    return rows.withColumn("is_id", F.col("key") == F.lpad(F.col("id").cast("string"), 6, "0"))


_rule_sql = " UNION ALL ".join(
    f"SELECT id, {v.quoted(label)} AS label, generate_subscripts(m, 1) - 1 AS match_no, unnest(m) AS match "
    f"FROM (SELECT id, {v.extract('text', pattern)} AS m FROM texts)" for pattern, label in RULES)


@query("rule_matches", f"WITH {v.TEXTS} {_rule_sql}")
def rule_matches(spark, folder):
    return rules.matches(views.texts(spark, folder), RULES)


# -- sentences and chunks ---------------------------------------------------------------

def _sentences(spark, folder):
    return tok.sentence_features(views.texts(spark, folder))


def _sentence_rows(spark, folder):
    return _sentences(spark, folder).select("id", F.col("num_s").alias("sent_num"), "sentence")


def _chunks(spark, folder):
    return chunks.from_arrays(tok.sentence_arrays(views.texts(spark, folder)), "id", "sentences")


@query("sentences", f"""WITH {v.TEXTS}, arrays AS (SELECT id, {v.sentences('text')} AS s FROM texts)
SELECT id, generate_subscripts(s, 1) - 1 AS sent_num, unnest(s) AS sentence FROM arrays""")
def sentences(spark, folder):
    return tok.sentence_rows(views.texts(spark, folder))


@query("sentence_features", f"WITH {v.SENTENCES} SELECT id, num_s, length(sentence) AS len_s, sentence FROM sents")
def sentence_features(spark, folder):
    return _sentences(spark, folder)


@query("sentence_report", f"""WITH {v.SENTENCES} SELECT id, count(*) AS n_sentences,
CAST(sum(length(sentence)) AS BIGINT) AS total_len, max(length(sentence)) AS longest FROM sents GROUP BY id""")
def sentence_report(spark, folder):
    return _sentences(spark, folder).groupBy("id").agg(
        F.count("*").alias("n_sentences"), F.sum("len_s").alias("total_len"), F.max("len_s").alias("longest")
    )


@query("short_sentences", f"""WITH {v.SENTENCES} SELECT id, num_s, length(sentence) AS len_s, sentence
FROM sents WHERE length(sentence) < 10""")
def short_sentences(spark, folder):
    return _sentences(spark, folder).where("len_s < 10")


@query("longest_sentences", f"""WITH {v.SENTENCES} SELECT id, num_s, length(sentence) AS len_s, sentence
FROM sents ORDER BY len_s DESC, id, num_s LIMIT 50""")
def longest_sentences(spark, folder):
    return _sentences(spark, folder).orderBy(F.desc("len_s"), "id", "num_s").limit(50)


@query("post_sentences_lookup", f"""WITH {v.POSTS_AND_TEXTS}, chosen AS (
SELECT id FROM posts ORDER BY comms_num DESC, id LIMIT 10), a AS (
SELECT id, text, {v.sentences(v.keep(v.for_embedding('text')))} AS s FROM texts WHERE id IN (SELECT id FROM chosen))
SELECT id, text, generate_subscripts(s, 1) - 1 AS sent_num, unnest(s) AS sentence FROM a""")
def post_sentences_lookup(spark, folder):
    top = views.post_activity(spark, folder).orderBy(F.desc("comms_num"), "id").limit(10)
    return tok.lookup_sentences(views.texts(spark, folder), top)


@query("running_spaces", f"WITH {v.CHUNKS} SELECT id, num_s AS sent_num, space_count, running_spaces FROM running")
def running_spaces(spark, folder):
    return chunks.running_spaces(_sentence_rows(spark, folder)).drop("sentence")


@query("chunk_sentences", f"WITH {v.CHUNKS} SELECT * FROM chunks")
def chunk_sentences(spark, folder):
    return _chunks(spark, folder)


@query("chunk_sentences_raw", f"WITH {v.CHUNKS} SELECT * FROM raw_chunks")
def chunk_sentences_raw(spark, folder):
    return chunks.from_rows(_sentence_rows(spark, folder), renumber=False)


@query("chunk_keep_long", f"WITH {v.CHUNKS} SELECT * FROM chunks WHERE length(long_sent) > 100")
def chunk_keep_long(spark, folder):
    return chunks.keep_long(_chunks(spark, folder))
