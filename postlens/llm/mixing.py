"""Mixing sources to target weights by Poisson replication, in SQL functions only.

Each source gets a mean repetition rate that brings its share of the characters to the target.
A document's number of copies is the inverse of the Poisson distribution of that mean at a point
that a hash of its id gives, so it is the same in every run and on every partitioning. Copies
are then spread over all partitions by a hash and ordered by it there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from postlens.llm.frames import fresh
from postlens.operators.joins import lookup_join

SEED = 17
#: A mean above this is split into equal parts, whose counts are drawn one by one and added.
PART_MEAN = 32.0
#: Width of a source's row for the join, in units of a row of numbers: its distribution has up to 133 terms.
ROW_UNITS = 24


def _key(source: str) -> Column:
    """Source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _distribution(mean: Column) -> Column:
    """Poisson probabilities of at most 0, 1, ... as an array that ends where doubles reach 1."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    zero = F.exp(-mean)
    start = F.struct(zero.alias("term"), zero.alias("total"), F.array(zero).alias("sums"))

    def step(acc, k):
        term = acc["term"] * mean / k
        total = acc["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), F.concat(acc["sums"], F.array(total)).alias("sums"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["sums"])


def rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0) -> DataFrame:
    """(key, characters, rate): mean number of copies of a document of each source.

    The size of a document is its number of code points plus one for its end. ``weights`` gives
    target weights by source; a source that it does not name gets none. Without it all sources
    weigh the same. The mixed corpus has ``size`` times the characters of ``docs``.
    """
    amount = F.coalesce(F.length("text"), F.lit(0)) + 1
    table = docs.groupBy(_key("source").alias("key")).agg(F.sum(amount).cast("bigint").alias("characters"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("key") == f"={source}", F.lit(float(value))).otherwise(weight)
    table = table.withColumn("weight", weight)
    all_of = table.agg(F.sum("characters").alias("c"), F.sum("weight").alias("w")).first()  # one row
    total, sum_weights = float(all_of["c"] or 0), all_of["w"] or 1.0
    rate = F.col("weight") * F.lit(size * total) / (F.lit(sum_weights) * F.col("characters"))
    return table.select("key", "characters", rate.alias("rate"))


def counted(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, seed: int = SEED,
            rate: str = "rate", copies: str = "copies") -> DataFrame:
    """``docs`` with the rate of its source and the number of copies of each row.

    Rows with the same doc_id and source get the same number; a null doc_id is hashed as "null", a
    null source is a source of its own. Other columns are kept and not read. ``rate`` and ``copies``
    must be names that ``docs`` does not have.
    """
    key = fresh(docs, "key")
    cdf, parts = fresh(docs, "cdf"), fresh(docs, "parts")
    table = rates(docs, weights, size)
    n = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int")
    table = table.select(F.col("key").alias(key), F.col("rate").alias(rate), n.alias(parts),
                         _distribution(F.col("rate") / n).alias(cdf))
    joined = lookup_join(docs.withColumn(key, _key("source")), table, [key], rows=ROW_UNITS * table.count())
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))

    def draw(part):
        point = _uniform(F.lit(str(seed)), name, part.cast("string"))
        return F.size(F.filter(cdf, lambda c: c <= point))
    drawn = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda acc, part: acc + draw(part))
    return joined.withColumn(copies, drawn).select(*docs.columns, rate, copies)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, seed: int = SEED,
        rate: str = "rate", copy: str = "copy") -> DataFrame:
    """``docs`` replicated and shuffled, with the rate and the number of the copy, from 1.

    Null and empty texts are replicated like others. An empty table gives an empty one. If ``docs`` has a column
    of one of the two names, it is kept and the new one gets underscores in front.
    """
    rate, copy = fresh(docs, rate), fresh(docs, copy)
    copies, order = fresh(docs, "copies"), fresh(docs, "order")
    rows = counted(docs, weights, size, seed, rate, copies).where(F.col(copies) > 0)
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    rows = rows.withColumn(order, F.xxhash64(F.lit(seed), "doc_id", copy))
    return rows.repartition(order).sortWithinPartitions(order).select(*docs.columns, rate, copy)
