"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks. On a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventweft")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings that results depend on; all can be changed in a live session.

    Timestamps in documents carry no zone once repaired, so the zone is fixed. A repeated key
    inside one JSON object keeps its last value instead of voiding the document. A value that does not
    fit its place in a document's shape voids the quick parse, so that the careful one reads it. Projections of
    many columns generate methods larger than the JVM compiles; above its limit of 8000 bytes
    Spark then splits the projection instead of leaving it to the bytecode interpreter. Words
    compared without regard to case are plain ASCII, for which the JVM's case mapping suffices.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.json.enablePartialResults", "false")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.icu.caseMappings.enabled", "false")
    return spark


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="eventweft-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Where none is named one is made only for a master on this
    very machine, as in tests, whose folders all tasks share; on a cluster that is an error."""
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return _own_folder()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; the caller writes a table there."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df, label: str):
    """Write a frame as a table in the shared folder and read it back.

    This cuts lineage: a lost executor costs a re-read of files, not a re-run of the job, and
    each reader loads only the columns it uses.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
