"""Newest version of each row, and rows not stored before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def latest_per_key(rows: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by the ``newest`` columns, which should order rows totally.

    Keeping rank 1 lets Spark cut each map task's rows to one per key before the shuffle, so a
    key with very many rows costs one row per task and no task sees them all.
    """
    by = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in newest])
    return rows.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") == 1).drop("_rank")


def newest_first(rows: DataFrame, column: str, *ties: str) -> DataFrame:
    return rows.orderBy(F.col(column).desc_nulls_last(), *ties)


def new_only(rows: DataFrame, stored: DataFrame, key: str | Sequence[str] = "id") -> DataFrame:
    """Rows whose key is not stored yet.

    The stored side grows without end, so its keys are first cut down to those of the batch. Spark
    measures the batch's keys as it runs and broadcasts them if they are few: the store is then scanned
    for its key columns and not shuffled. Nothing is broadcast on a caller's word.
    """
    names = [key] if isinstance(key, str) else list(key)
    known = stored.select(*names).join(rows.select(*names), names, "left_semi")
    return rows.join(known, names, "left_anti")
