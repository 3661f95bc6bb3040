"""Intermediate tables in the folder that all executors and the driver share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a local folder is set only where the session has none and runs on one
    machine (tests)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not base and have.isDefined():
        base = have.get()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexispark-")
    if not have.isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def lean(f: Callable) -> Callable:
    """A function of batches that gives its memory back at its end: Spark keeps Python workers for later tasks, and a
    worker that waits should not hold what the last task needed."""

    @functools.wraps(f)
    def run(batches, *args, **kwargs):
        yield from f(batches, *args, **kwargs)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # there is no such call in other C libraries
            ctypes.CDLL(None).malloc_trim(0)

    return run


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most so many rows a batch between the JVM and Python: Spark's default of 10,000 is for short rows, and whole
    texts of that number take hundreds of MB a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate tables when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more, and has the driver collect its garbage, so that Spark's cleaner
    deletes the shuffle files of writes that have ended; else these stay on the executors' disks until the driver's heap
    happens to fill."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in {f.rsplit("/", 1)[0] for table in tables for f in table.inputFiles()}:
        path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path(folder), True)
    gc.collect()
    spark._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: it cuts the lineage, outlives a lost
    executor, and what a task numbered (chunk ids) never changes in a later attempt."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    forget(spark, path)
    return spark.read.schema(df.schema).parquet(path)
