"""Global row positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from postlens.session import cut


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Number rows 0, 1, ... in the given total order.

    Rows are range-partitioned and sorted; only one count per partition is summed up,
    and each row adds its place inside the partition. A frequent value is split between
    partitions as long as ``order`` ends in a unique column.
    """
    parts = df.sparkSession.sparkContext.defaultParallelism
    parts = max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    row_id = F.monotonically_increasing_id()
    ordered = cut(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(row_id, 33))
        .withColumn("_place", row_id.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so the window and the broadcast are bounded by their number
    offsets = ordered.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return ordered.join(F.broadcast(offsets), "_part").withColumn(
        name, (F.col("_offset") + F.col("_place")).cast("bigint")
    ).drop("_part", "_place", "_offset")


def equal_slices(df: DataFrame, order: list[str], slices: int) -> DataFrame:
    """Cut rows into ``slices`` runs of equal length; the remainder at the end is dropped.
    With fewer rows than slices there is no slice."""
    numbered = with_position(df, order)
    size = F.floor(df.agg(F.count("*").alias("n")).scalar() / slices)
    return (
        numbered.withColumn("slice_no", F.floor(F.try_divide(F.col("position"), size)).cast("bigint"))
        .where(F.col("slice_no") < slices)
    )
