"""Term weights and hashed text vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postlens.operators.joins import lookup_join
from postlens.session import cut

BUCKETS = 64


def term_frequency(rows: DataFrame, term: str) -> DataFrame:
    """(id, term, tf)."""
    return rows.groupBy("id", F.col(term).alias("term")).agg(F.count("*").alias("tf"))


def tfidf(frequency: DataFrame, n_docs) -> DataFrame:
    """Add ``weight`` = tf * ln((N + 1) / (df + 1)).

    The counts are used twice, for the weights and for the document frequencies, so they
    are cut from the costly text work before them. A common term is in almost every
    document, so the join is guarded against one key with a large share of the rows.
    """
    frequency = cut(frequency)
    idf = frequency.groupBy("term").agg(F.count("*").alias("_df")).select(
        "term", F.ln((n_docs + 1) / (F.col("_df") + 1)).alias("_idf")
    )
    idf = cut(idf)
    joined = lookup_join(frequency, idf, ["term"], "inner", rows=idf.count())
    return joined.select("id", "term", "tf", (F.col("tf") * F.col("_idf")).alias("weight"))


def hash_embed(weights: DataFrame, ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(id, z): signed feature hashing of term weights, scaled to unit length.

    Bucket and sign come from the md5 of the term; a text without terms gets zeros.
    """
    digest = F.md5("term")
    sign = F.when(F.substring(digest, 5, 1) >= "8", -1.0).otherwise(1.0)
    bucket = (F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") % buckets).alias("bucket")
    parts = weights.groupBy("id", bucket).agg(F.sum(sign * F.col("weight")).alias("v"))
    # at most one entry per bucket, so the collected list is bounded; the length of the vector is a sum
    # beside it, as an expression over the whole vector would be computed again for each of its numbers
    entries = parts.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "v"))).alias("m"),
        F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"),
    )

    def scaled(i):
        value = F.element_at("m", i)
        return F.coalesce(F.when(F.col("norm") > 0, value / F.col("norm")).otherwise(value), F.lit(0.0))

    rows = ids.select("id").join(entries, "id", "left")
    return rows.select("id", F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), scaled).alias("z"))


def embed_with(df: DataFrame, text: str, encoder, batch_size: int = 32) -> DataFrame:
    """(all columns, z) with a caller's model: ``encoder(list of texts) -> rows of floats``."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField("z", T.ArrayType(T.DoubleType()))])

    def run(frames):
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                batch = frame.iloc[start:start + batch_size]
                vectors = encoder(batch[text].tolist())
                yield batch.assign(z=[[float(x) for x in row] for row in vectors])

    return df.mapInPandas(run, schema)
