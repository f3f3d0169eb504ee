"""Running totals over a whole table without ordering it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventweft.session import staged


def ranged(rows: DataFrame, order: Sequence[str], name: str = "_range") -> DataFrame:
    """The rows sorted in ranges, each with the number of its range, written to the shared folder.

    Spark samples the rows for the cuts and joins small ranges by their bytes: their number follows the
    data. Every row of a range comes before those of the next, equal rows share a range.
    """
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(cut.withColumn(name, F.spark_partition_id()), "ranges")


def running_total(rows: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows up to and with each row, in the given order.

    The order must tell rows apart. Sums of whole ranges, one number for each, are added up first, then
    each range adds its own rows.
    """
    cut = ranged(rows, order)
    whole = cut.groupBy("_range").agg(F.sum(value).alias("_sum"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, at most as many as shuffle partitions.
    offsets = whole.select("_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = cut.withColumn("_inside", F.sum(value).over(inside)).join(F.broadcast(offsets), "_range")
    return total.withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside")
