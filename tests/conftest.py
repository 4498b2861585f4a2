import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return rows.selectExpr("vec_id", "transform(embedding, x -> CAST(x AS DOUBLE)) AS z", "label AS cluster").cache()
