"""Exact length histogram of encoded documents, and what it answers for every context limit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from postlens.llm.frames import written
from postlens.llm.token_files import encoder, text_blocks

#: Lengths per group when sums are carried over all lengths; one row per group meets in one task.
GROUP = 1024


def _counter(path: str):
    def run(batches):
        coder = encoder(path)
        for _, _, _, texts in text_blocks(batches):
            _, count = coder.encode(texts)
            found, docs = np.unique(count, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(docs)], names=["n_tokens", "docs"])
    return run


def histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(n_tokens, docs): number of rows of each encoded length, without end ids.

    Null counts as the empty text, of length 0. Repeated rows count each time. An empty table
    has an empty histogram. Only text is read.
    """
    return docs.select("text").mapInArrow(_counter(vocabulary), "n_tokens bigint, docs bigint").groupBy(
        "n_tokens").agg(F.sum("docs").alias("docs"))


def limits(lengths: DataFrame) -> DataFrame:
    """What each context limit keeps, from a histogram (n_tokens, docs).

    One row per length that occurs, as limit: documents and tokens of that length or less
    (docs_within, tokens_within), documents and tokens that are longer (docs_over,
    tokens_over), tokens left when longer documents are cut at the limit (truncated_tokens), and the
    share of documents within, so the smallest limit of a share of at least q is the q-quantile.
    A limit between two rows keeps what the row below it says plus (limit - n_tokens) x docs_over.
    """
    # read twice below: without the table the histogram would be computed, that is encoded, twice
    sized = written(lengths.select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"),
                                   F.floor(F.col("n_tokens") / GROUP).alias("part")))
    parts = sized.groupBy("part").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(
        "part", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    inside = Window.partitionBy("part").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    suffix = sized.withColumns({
        "d_in": F.coalesce(F.sum("docs").over(inside), F.lit(0)), "t_in": F.coalesce(F.sum("tokens").over(inside), F.lit(0))})
    over = suffix.join(parts, "part").select(
        "n_tokens", "docs", "all_docs", "all_tokens", (F.col("d_in") + F.col("d_after")).alias("docs_over"),
        (F.col("t_in") + F.col("t_after")).alias("tokens_over"))
    within = F.col("all_tokens") - F.col("tokens_over")
    return over.select(
        "n_tokens", "docs", (F.col("all_docs") - F.col("docs_over")).alias("docs_within"), within.alias("tokens_within"),
        "docs_over", "tokens_over", (within + F.col("n_tokens") * F.col("docs_over")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("share_within"))


def quantile(table: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share ``q`` of documents does not exceed."""
    return table.where(F.col("share_within") >= q).agg(F.min("n_tokens")).first()[0]


def truncated(table: DataFrame, limit: int) -> int:
    """Tokens left when documents are cut at ``limit``, which need not be a length that occurs."""
    row = table.where(F.col("n_tokens") <= limit).orderBy(F.desc("n_tokens")).first()
    if row is not None:
        return row["tokens_within"] + limit * row["docs_over"]
    least = table.orderBy("n_tokens").first()
    return 0 if least is None else limit * (least["docs_within"] + least["docs_over"])
