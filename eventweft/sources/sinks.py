"""Tables written by status and id range, in dependency order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventweft.operators import dedup as D
from eventweft.operators import extract as E
from eventweft.operators import quality as Q
from eventweft.plans.run import VERSION_ORDER, Batch
from eventweft.session import staged
from eventweft.spec import Model

# Rows per database statement by the size of the batch.
BATCH_SIZES = ((10_000, 1_000), (100_000, 5_000))
LARGEST_BATCH = 10_000


def batch_size(rows: int) -> int:
    return next((size for below, size in BATCH_SIZES if rows < below), LARGEST_BATCH)


def jdbc_write_options(options: Mapping[str, str], table: str, rows: int) -> dict[str, str]:
    return {**options, "dbtable": table, "batchsize": str(batch_size(rows)), "rewriteBatchedStatements": "true"}


def append_jdbc(rows: DataFrame, options: Mapping[str, str], table: str, count: int) -> None:
    rows.write.format("jdbc").mode("append").options(**jdbc_write_options(options, table, count)).save()


def batch_path(base: str, day: dt.date, first_id: int, last_id: int) -> str:
    return f"{base}/{day:year=%Y/month=%m/day=%d}/batch={first_id}-{last_id}"


def table_path(batch: str, status: str, table: str) -> str:
    return f"{batch}/status={status}/table_name={table}"


def stored_glob(base: str, table: str) -> str:
    return table_path(f"{base}/year=*/month=*/day=*/batch=*", "succeeded", table)


def stored_ids(spark: SparkSession, base: str, without: str) -> DataFrame:
    """(table_name, id) of the sound rows of all batches but the one named, such as ``1-600``."""
    schema = T.StructType([T.StructField("id", T.StringType())])
    try:
        rows = spark.read.schema(schema).option("basePath", base).parquet(f"{base}/year=*/month=*/day=*/batch=*/status=succeeded")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "table_name string, id string")
        raise
    return rows.filter(F.col("batch").cast("string") != without).select(F.col("table_name").cast("string").alias("table_name"), "id")


@dataclass(frozen=True)
class Written:
    table: str
    status: str
    rows: int
    path: str


def alike(model: Model) -> list[list[str]]:
    """The tables in as few groups as find room, so that within a group columns of one name have one type."""
    groups: list[tuple[list[str], dict[str, T.DataType]]] = []
    for name in model.write_order:
        columns = {f.name: f.dataType for f in model.table(name).schema()}
        for names, known in groups:
            if all(known.get(c, kind) == kind for c, kind in columns.items()):
                break
        else:
            names, known = [], {}
            groups.append((names, known))
        names.append(name)
        known.update(columns)
    return [names for names, _ in groups]


def tagged(batch: Batch, names: Sequence[str]) -> DataFrame:
    """All rows of these tables, sound and failed, as one frame with ``table_name`` in front."""

    def rows(name: str) -> DataFrame:
        found = batch.all_rows(name)
        ord_ = F.col(E.ORD) if E.ORD in found.columns else F.lit(None).cast("array<int>")
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in batch.model.table(name).schema()]
        return found.select(F.lit(name).alias("table_name"), *columns, ord_.alias(E.ORD), Q.REASONS)

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows(n) for n in names])


def settled(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Tagged rows as they are stored: of the sound ones the newest version of each id that ``stored`` lacks, and all
    failed ones. One shuffle serves all tables."""
    sound = D.latest_per_key(rows.filter(Q.passes()), ["table_name", "id"], [*VERSION_ORDER, E.ORD])
    sound = D.new_only(sound, stored, ["table_name", "id"]).withColumn(Q.REASONS, F.lit(None).cast("array<string>"))
    parts = [(sound, "succeeded"), (rows.filter(~Q.passes()), "failed")]
    return reduce(lambda a, b: a.unionByName(b), [p.withColumn("status", F.lit(s)) for p, s in parts]).drop(E.ORD)


def write_batch(
    batch: Batch,
    base: str,
    day: dt.date,
    first_id: int,
    last_id: int,
    append: Callable[[str, DataFrame, int], None] | None = None,
) -> list[Written]:
    """Every table of a batch: sound rows new to the store, and failures. Tables without rows leave nothing.

    All tables whose columns agree are one frame, written by one job into a folder for each status and table,
    whatever their number. Rows are counted from the files just written, of which only the footers are read. The
    batch's folder carries its id range and is overwritten, so a repeated batch leaves one copy, and its
    own range is not counted as stored.

    ``append`` takes the sound rows of a table further, such as to a database, parents first, read back from
    the files. The answer is in that order too.
    """
    spark = batch.landed.sparkSession
    if batch.staged is None and len(batch.model.write_order) > 1:
        batch = Batch(batch.model, batch.landed, staged(batch.wide(), "wide"))
    path = batch_path(base, day, first_id, last_id)
    for i, names in enumerate(alike(batch.model)):
        out = settled(tagged(batch, names), stored_ids(spark, base, f"{first_id}-{last_id}"))
        out.write.mode("append" if i else "overwrite").partitionBy("status", "table_name").parquet(path)
    found = {(r["status"], r["table_name"]): r["n"] for r in _counted(spark, path).collect()}
    out = []
    for name in batch.model.write_order:
        for status in ("succeeded", "failed"):
            rows = found.get((status, name), 0)
            if not rows:
                continue
            out.append(Written(name, status, rows, table_path(path, status, name)))
            if append is not None and status == "succeeded":
                append(name, spark.read.schema(batch.model.table(name).schema()).parquet(out[-1].path), rows)
    return out


def _counted(spark: SparkSession, path: str) -> DataFrame:
    """Rows by status and table, of folders that hold files."""
    schema = T.StructType([T.StructField("id", T.StringType())])
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/status=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "status string, table_name string, n bigint")
        raise
    return rows.groupBy("status", "table_name").agg(F.count(F.lit(1)).alias("n"))
