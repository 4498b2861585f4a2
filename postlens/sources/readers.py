"""Scans: every file format of the posts data, with declared schemas."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

POSTS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("comms_num", T.LongType()),
    T.StructField("created", T.DoubleType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
CHUNKS_SCHEMA = "post_id string, chunk_num int, long_sent string"
#: Bytes of text in one task of a job that makes many rows of each text and counts them.
PIECE_BYTES = 4 << 20
CHUNK_DEFAULTS = {"post_id": "", "chunk_num": 0, "long_sent": ""}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan by ``key`` when it has fewer splits than there are cores.

    A small file with one row group would keep one core busy. A large input already
    has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(cores, key)


def in_pieces(df: DataFrame, key: str, text: str, piece_bytes: int | None = None) -> DataFrame:
    """Hash-partition rows by ``key`` into pieces of about ``piece_bytes`` of text each.

    More input makes more pieces, not larger ones, and what is counted per key afterwards stays in its piece
    without another shuffle. There are at least as many pieces as cores.
    """
    size = df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // (piece_bytes or PIECE_BYTES))), key)


def read_csv(
    spark: SparkSession, path: str, schema, sep: str = ",", quoting: bool = True,
    multiline: bool = True, keep_empty: bool = False, glob: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Delimited text with header. ``quoting=False`` reads quote characters as data.

    ``multiline`` lets quoted fields span lines, at the price of one task per file.
    ``keep_empty`` gives empty strings instead of nulls.
    """
    reader = spark.read.schema(schema).option("header", True).option("sep", sep)
    reader = reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if quoting:
        reader = reader.option("quote", '"').option("escape", '"').option("multiLine", multiline)
    else:
        reader = reader.option("quote", "")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format).option(
            "timestampFormat", timestamp_format
        )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    if keep_empty:
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.fillna("", subset=strings)
    return df


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Per-column default for missing values."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
        if c in defaults else F.col(c)
        for c in df.columns
    ])


def seeded_order(key: Column, seed: int) -> Column:
    """Sort key of a repeatable shuffle that does not depend on the partitioning."""
    return F.md5(F.concat_ws("_", key.cast("string"), F.lit(str(seed))))


def in_batches(df: DataFrame, function, schema, batch_size: int = 32) -> DataFrame:
    """Run ``function(pandas frame) -> pandas frame`` over batches of at most ``batch_size`` rows."""
    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield function(frame.iloc[start:start + batch_size])
    return df.mapInPandas(run, schema)


def lemma_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``lemma->form<TAB>form...`` lines as (form, lemma) rows."""
    parts = F.split(F.col(column), "->", 2)
    return (
        lines.where(F.col(column).contains("->"))
        .select(F.trim(parts[0]).alias("lemma"), F.explode(F.split(parts[1], "\t")).alias("form"))
        .select(F.trim("form").alias("form"), "lemma")
        .where("form <> ''")
    )


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    return lemma_lines(spark.read.text(path))


def read_rules(spark: SparkSession, path: str, limit: int = 1000) -> list[tuple[str, str]]:
    """``regex~label`` lines as configuration; a longer file is refused, not cut."""
    rows = spark.read.text(path).where("value <> ''").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} match rules in {path}")
    return [tuple(r.value.rsplit("~", 1)) for r in rows]


def link_texts(pages: DataFrame, html: str = "html", key: str = "page_id", prefix: str = "") -> DataFrame:
    """Anchor texts that start with ``prefix``, with their white-space parts."""
    anchors = F.regexp_extract_all(F.col(html), F.lit("<a [^>]*>([^<]*)</a>"), F.lit(1))
    return (
        pages.select(key, F.posexplode(anchors).alias("link_no", "link_text"))
        .where(F.col("link_text").startswith(prefix))
        .select(
            key, "link_no", "link_text",
            F.size(F.filter(F.split("link_text", r"\s+"), lambda p: p != "")).alias("n_parts"),
        )
    )


def read_params(spark: SparkSession, path: str, **params) -> DataFrame:
    """Rows of a parameter-partitioned result table; the filters prune folders."""
    df = spark.read.parquet(path)
    for name, value in params.items():
        df = df.where(F.col(name) == F.lit(value))
    return df
