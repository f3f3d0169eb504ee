"""What the operators share: reading tables, the shared folder, staged tables, bounded samples."""

from __future__ import annotations

import functools
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.lru_cache(maxsize=1)
def _ship(application: str) -> None:
    """Sends this package to the Python workers of the application, wherever they run."""
    package = pathlib.Path(__file__).resolve().parent.parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="eventweft-")) / "eventweft_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ship(spark.sparkContext.applicationId)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only on one machine (master ``local[...]``), where every
    folder is shared, is one made when the setting is absent; on a cluster that is an error."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="eventweft-")
        context.setCheckpointDir(path)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path, with its scheme, below the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.deleteOnExit(hadoop_path)
    full = store.makeQualified(hadoop_path).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and full[6:7] != "/" else full


def staged(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again, so that an executor's loss costs nothing
    and no branch computes it twice."""
    path = scratch(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fold_id(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def hashed_sample(frame: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of the columns ``by``: a sample that is the
    same for every layout of the files."""
    mark = F.xxhash64(*[F.col(c) for c in by])
    return frame.withColumn("__mark", mark).orderBy("__mark", *by).limit(rows).drop("__mark")


def texts_of(batches: Iterator[pa.RecordBatch], size: int = 1 << 24, column: str | int = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut to about ``size`` bytes of their text column, with its values; NULL reads as empty."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        per_row = max(1, batch.column(column).nbytes // rows)
        step = max(1, size // per_row)
        for start in range(0, rows, step):
            part = batch.slice(start, step)
            yield part, [t or "" for t in part.column(column).to_pylist()]


def record_batch(columns: Iterable[tuple[str, object, pa.DataType]]) -> pa.RecordBatch:
    columns = list(columns)
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, t) for _, v, t in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _, _ in columns])


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each pair, one after the other."""
    total = int(length.sum())
    shift = np.repeat(start - (np.cumsum(length) - length), length)
    return np.arange(total) + shift


def sliced(batch: pa.Array, size: int = 1 << 23) -> Iterator[pa.Array]:
    """Parts of about ``size`` bytes."""
    step = max(1, size // max(1, batch.nbytes // max(1, len(batch))))
    for start in range(0, len(batch), step):
        yield batch.slice(start, step)
