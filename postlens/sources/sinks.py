"""Writers for stage outputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False) -> None:
    """Delimited text with header, embedded quotes doubled.

    ``single_file`` writes through one task and is meant for small results only.
    """
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite").option("header", True).option("sep", sep)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def run_folder(base: str, name: str, run_id: str) -> str:
    """Output folder of one run, e.g. ``sentences_2021-02-13_10-11-12``."""
    return os.path.join(base, f"{name}_{run_id}")


def write_params(df: DataFrame, path: str, params: list[str], mode: str = "overwrite") -> None:
    """One table for all parameter combinations, one folder per combination."""
    df.write.mode(mode).partitionBy(*params).parquet(path)


def write_scores(df: DataFrame, path: str) -> None:
    """Grid scores as JSON lines with the parameters as real columns."""
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
