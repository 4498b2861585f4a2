"""Multi-line CSV over many tasks against Spark's own multi-line reader."""

import random

import pytest

from postlens.sources import multiline, readers

SCHEMA = "id long, a string, b string"


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(path, rng, n, end):
    pieces = ["word", ' "said"', end, end + end, ",", "é🚀", '"', " ", "long " * 60, ""]
    lines = ["id,a,b"]
    for i in range(n):
        fields = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(2)]
        lines.append(f"{i}," + ",".join(quoted(f) if f or rng.random() < 0.5 else f for f in fields))
        if rng.random() < 0.1:
            lines.append("")
    path.write_bytes((end.join(lines) + end).encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_reader_of_one_task(small_splits, tmp_path, end):
    spark, rng = small_splits, random.Random(7)
    for k in range(3):
        write(tmp_path / f"part{k}.csv", rng, 60, end)
    (tmp_path / "part9.csv").write_bytes(f"id,a,b{end}".encode())
    split = multiline.read_csv(spark, str(tmp_path), SCHEMA, glob="part*")
    single = readers.read_csv(spark, str(tmp_path), SCHEMA, glob="part*")
    assert split.schema == single.schema
    assert sorted(map(str, split.collect())) == sorted(map(str, single.collect()))
    assert multiline.lines_of(spark, str(tmp_path)).rdd.getNumPartitions() > 20


def test_record_over_many_splits(small_splits, tmp_path):
    long = "\n".join(f'line {i} ""x""' for i in range(400))
    (tmp_path / "x.csv").write_text(f'id,a,b\n1,"{long}",y\n2,"z","w"')
    rows = multiline.read_csv(small_splits, str(tmp_path / "x.csv"), SCHEMA).collect()
    assert sorted((r.id, len(r.a), r.b) for r in rows) == [(1, len(long.replace('""', '"')), "y"), (2, 1, "w")]
