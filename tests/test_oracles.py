"""Every query with SQL agrees with it on the smallest data set."""

import pytest

import __spark_entry__ as entry
from check import compare, connection

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    got, want, have, expect = compare(spark, con, FOLDER, name)
    assert have == expect
    assert got == want


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["post_id", "chunk_num", "long_sent"]
    assert rows.count() > 0
