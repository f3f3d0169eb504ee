"""Stored tables: Parquet by path, or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table, or no rows before the first write. Any other failure is an error.

    A lookup that failed must not make every row look new.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def jdbc_table_options(
    options: Mapping[str, str], table: str, schema: StructType | None = None, split: tuple[str, int, int, int] | None = None
) -> dict[str, str]:
    """Reader options for a whole table; the name is quoted for the database.

    ``split`` names a numeric column, its bounds and a number of parallel reads.
    """
    quoted = ".".join('"' + part.replace('"', '""') + '"' for part in table.split("."))
    out = {**options, "dbtable": quoted}
    if schema is not None:
        out["customSchema"] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    if split is not None:
        column, low, high, parts = split
        out |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return out


def scan_jdbc(spark: SparkSession, options: Mapping[str, str], table: str, **more) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_table_options(options, table, **more)).load()


def query_jdbc(spark: SparkSession, options: Mapping[str, str], sql: str) -> DataFrame:
    """A SELECT that the database runs."""
    return spark.read.format("jdbc").options(**options, query=sql.strip().rstrip(";")).load()
