"""Inputs on which a division or an empty set used to stop a job."""

from pyspark.sql import functions as F

from postlens.operators import joins, neighbours, ordering, stats, timeseries


def test_describe_one_row(spark):
    row = stats.describe(spark.range(1), "id").first()
    assert row.n_rows == 1 and row["std"] is None and row.p50 == 0


def test_density_of_a_constant(spark):
    rows = stats.density(spark.range(3).select(F.lit(5).alias("v")), "v", 4).collect()
    assert len(rows) == 4 and all(r.density is None for r in rows)


def test_bins_of_equal_times(spark):
    rows = spark.range(3).selectExpr("TIMESTAMP_NTZ'2021-01-01 00:00:00' AS t")
    assert {r.bin for r in timeseries.time_bins(rows, "t", 7).collect()} == {0}


def test_more_slices_than_rows(spark):
    assert ordering.equal_slices(spark.range(3), ["id"], 10).count() == 0
    assert ordering.equal_slices(spark.range(10), ["id"], 3).count() == 9


def test_neighbours_of_nothing(spark):
    rows = spark.createDataFrame([], "vec_id bigint, z array<double>")
    assert neighbours.knn(rows, 3).count() == 0


def test_broadcast_limit_units(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, size in (("256k", 1 << 18), ("10MB", 10 << 20), ("1g", 1 << 30), ("77", 77), ("-1", -1), ("5b", 5)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert joins.broadcast_limit(spark.range(1)) == size
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
