"""Consecutive numbers for the rows of a sorted table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.session import checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition in the low 33 bits


def number_rows(df: DataFrame, key: str, into: str) -> DataFrame:
    """Add ``into`` = 0..n-1 in the order of the unique column ``key``.

    The table is range-partitioned and written once; the number of a row is its place in its
    partition plus the sizes of the partitions before. Only those sizes, one row per partition,
    meet in one task and are broadcast.
    """
    sorted_rows = df.repartitionByRange(key).sortWithinPartitions(key)
    written = checkpoint(sorted_rows.withColumn("_place", F.monotonically_increasing_id()))
    placed = written.withColumn("_part", F.shiftright("_place", _ROW_BITS)).withColumn(
        "_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(into, F.col("_before") + F.col("_row"))
        .drop("_place", "_part", "_row", "_before")
    )
