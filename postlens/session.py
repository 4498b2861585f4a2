"""Session defaults and the lineage cut used by the iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "postlens") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder.

    A cluster has to name one that every executor can read; only a local session
    may fall back to a scratch folder of this machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="postlens-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` as a table in the shared folder, in folders ``by`` value of some columns. A checkpoint keeps the size
    that the optimiser guessed, and guesses multiply along an iteration that joins its own results; a table has its true size."""
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
