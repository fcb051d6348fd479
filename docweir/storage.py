"""Shared working storage: tables written once and read back by later steps.

A written table cuts lineage and survives the loss of executors, because it lies in
the folder that the cluster names in ``spark.checkpoint.dir``. Only a local session
that names none gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
#: Removes a job's shuffle files when it ends, instead of whenever the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that Python gets at a time while a table is written; a batch of texts lies in the JVM and in Python.
_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="docweir-")
    return _LOCAL_DIRS[app]


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/docweir/{name}-{uuid.uuid4().hex}"
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)
    fs.cancelDeleteOnExit(hadoop_path)


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in (_CLEANUP, _BATCH)}
    spark.conf.set(_CLEANUP, "true")
    if not 0 < int(before[_BATCH] or 0) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def write_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet, remove the shuffle files that took, which nothing reads again, and return a scan of what was written."""
    spark = df.sparkSession
    with _writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a scan of what was written."""
    return write_at(df, new_path(df.sparkSession, name))
