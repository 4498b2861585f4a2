"""Scans, sinks and guarded joins."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from postlens.operators import features, ordering
from postlens.operators.joins import lookup_join
from postlens.plans import vector_queries
from postlens.sources import readers, sinks

ROWS = [("a", 0, 'say "hi",\nthen\tgo'), ("b", 1, " spaced "), ("c", 2, "é🚀")]


def test_csv_round_trip_with_quotes_and_lines(spark, tmp_path):
    df = spark.createDataFrame(ROWS, readers.CHUNKS_SCHEMA)
    for sep in (",", "\t"):
        path = str(tmp_path / f"csv{ord(sep)}")
        sinks.write_csv(df, path, sep=sep, single_file=True)
        assert len([f for f in os.listdir(path) if f.startswith("part")]) == 1
        back = readers.read_csv(spark, path, readers.CHUNKS_SCHEMA, sep=sep, glob="part*")
        assert sorted(map(tuple, back.collect())) == sorted(ROWS)


def test_quoting_off_keeps_quotes(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('post_id\tchunk_num\tlong_sent\nq\t3\t"a" b"\n')
    back = readers.read_csv(spark, str(path), readers.CHUNKS_SCHEMA, sep="\t", quoting=False)
    assert tuple(back.first()) == ("q", 3, '"a" b"')


def test_posts_scan_with_dates_and_empty_strings(spark, tmp_path):
    path = tmp_path / "posts.csv"
    path.write_text('id,title,body,url,comms_num,created,timestamp\n'
                    'x1,T,,u,7,1.5,2021-01-28 21:37:41\n"x2","a ""b""","l1\nl2",u,8,2.5,2021-01-29 00:00:00\n')
    df = readers.read_csv(spark, str(path), readers.POSTS_SCHEMA, keep_empty=True,
                          timestamp_format="yyyy-MM-dd HH:mm:ss")
    rows = {r.id: r for r in df.collect()}
    assert rows["x1"].body == "" and rows["x1"].timestamp == dt.datetime(2021, 1, 28, 21, 37, 41)
    assert rows["x2"].title == 'a "b"' and rows["x2"].body == "l1\nl2"
    plain = readers.read_csv(spark, str(path), readers.POSTS_SCHEMA)
    assert plain.where("id = 'x1'").first().body is None


def test_defaults_and_batches(spark):
    df = spark.createDataFrame([("p", None, None), (None, 4, "s")], readers.CHUNKS_SCHEMA)
    rows = readers.with_defaults(df, readers.CHUNK_DEFAULTS).collect()
    assert sorted(map(tuple, rows)) == [("", 4, "s"), ("p", 0, "")]
    import pandas as pd
    sizes = readers.in_batches(spark.range(70).coalesce(1), lambda f: pd.DataFrame({"n": [len(f)]}), "n long", 32)
    assert sorted(r.n for r in sizes.collect()) == [6, 32, 32]


def test_rule_and_lemma_files(spark, tmp_path):
    (tmp_path / "rules").write_text("a|b~letters\n[0-9]~x~digits\n")
    assert readers.read_rules(spark, str(tmp_path / "rules")) == [("a|b", "letters"), ("[0-9]~x", "digits")]
    with pytest.raises(ValueError):
        readers.read_rules(spark, str(tmp_path / "rules"), limit=1)
    (tmp_path / "lemmas").write_text("be->is\twas\tare\nsell -> sold\nbroken line\n")
    got = {r.form: r.lemma for r in readers.read_lemmas(spark, str(tmp_path / "lemmas")).collect()}
    assert got == {"is": "be", "was": "be", "are": "be", "sold": "sell"}


def test_links(spark):
    html = '<a href="x">U+1F600 U+1F601</a><a>other</a><a class=y>U+2603</a>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = readers.link_texts(df, prefix="U+").orderBy("link_text").collect()
    assert [(r.link_text, r.n_parts) for r in rows] == [("U+1F600 U+1F601", 2), ("U+2603", 1)]


def test_parameter_tables_prune(spark, tmp_path):
    df = spark.createDataFrame([(5, 20, 1, 0), (5, 28, 1, 1), (6, 20, 1, -1)], "d int, m int, vec_id long, cluster int")
    sinks.write_params(df, str(tmp_path / "p"), ["d", "m"])
    part = readers.read_params(spark, str(tmp_path / "p"), d=5, m=28)
    assert [(r.vec_id, r.cluster) for r in part.collect()] == [(1, 1)]
    assert "PartitionFilters: [isnotnull(d" in part._jdf.queryExecution().toString()
    sinks.write_scores(df, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 3
    sinks.write_parquet(df, sinks.run_folder(str(tmp_path), "out", "r1"))
    assert spark.read.parquet(str(tmp_path / "out_r1")).exceptAll(df).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_salted_join_equals_broadcast_join(spark, how):
    big = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    wide = lookup_join(big, lookup, ["k"], how, limit=1 << 40)
    salted = lookup_join(big, lookup, ["k"], how, limit=-1, salts=5)
    assert wide.exceptAll(salted).isEmpty() and salted.exceptAll(wide).isEmpty()


def test_positions_follow_the_order_even_when_a_value_repeats(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).alias("t"), "id")
    rows = ordering.with_position(df, ["t", "id"]).orderBy("t", "id").collect()
    assert [r.position for r in rows] == list(range(5000))
    slices = ordering.equal_slices(df, ["t", "id"], 7).groupBy("slice_no").count().collect()
    assert sorted((r.slice_no, r["count"]) for r in slices) == [(i, 5000 // 7) for i in range(7)]


def test_more_text_makes_more_pieces_not_larger_ones(spark, tmp_path, monkeypatch):
    """Term counts of a text stay in its piece, whatever the number of shuffle partitions."""
    monkeypatch.setattr(readers, "PIECE_BYTES", 2000)
    rows = [(i if i % 50 else None, f"Title {i}\n" + f"alpha beta{i % 7} gamma " * 5) for i in range(400)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = vector_queries.term_frequency(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() >= sum(len(t) for _, t in rows) // 2000
    counts = {(r.id, r.term): r.tf for r in found.collect()}
    assert counts[1, "alpha"] == 10 and counts[8, "beta1"] == 10
    assert len(counts) == found.count()


def test_small_share_of_a_counted_table_is_hashed_not_sorted(spark):
    """Term weights join millions of counts with a vocabulary beyond the broadcast limit."""
    big = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    wide = lookup_join(big, lookup, ["k"], "left", limit=1 << 40)
    hashed = lookup_join(big, lookup, ["k"], "left", limit=-1, salts=5, rows=25)
    assert "ShuffledHashJoin" in hashed._jdf.queryExecution().toString()
    assert wide.exceptAll(hashed).isEmpty() and hashed.exceptAll(wide).isEmpty()
    many = lookup_join(big, lookup, ["k"], "left", limit=-1, salts=5, rows=1 << 40)
    assert "ShuffledHashJoin" not in many._jdf.queryExecution().toString()


def test_hashed_vectors_have_length_one_and_no_terms_give_zeros(spark):
    weights = spark.createDataFrame([(1, f"t{i}", float(i)) for i in range(9)] + [(2, "a", 0.0), (None, "b", 1.0)],
                                    "id long, term string, weight double")
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "id long")
    found = features.hash_embed(weights, ids)
    assert found._jdf.queryExecution().toString().count("aggregate(") == 0  # not once for each number
    rows = sorted(((r.id or 0), r.z) for r in found.collect())
    assert [i for i, _ in rows] == [0, 1, 1, 2, 3] and all(len(z) == 64 for _, z in rows)
    assert [round(sum(x * x for x in z), 9) for _, z in rows] == [0, 1, 1, 0, 0]
