"""Shared tables between the steps of an operator, and the settings its Python stages need."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loantape.operators.skew import shared_dir

# Texts reach Python in batches of so many rows, which bounds a batch of long texts.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/llm-{app}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read again: runs once, cuts the
    lineage, and outlives the executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def other_columns(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` that have none of these names, compared as the session compares them."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return [c for c in df.columns if c not in names]
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme; without one, Hadoop's default file system is meant."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


# What Python workers keep between the tasks of one operator, as functions that drop it.
worker_caches: list[Callable[[], None]] = []


def drop_caches() -> None:
    """Drop what other operators keep in this Python worker: workers live on into later stages."""
    for clear in worker_caches:
        clear()


def give_back() -> None:
    """Drop the caches, and hand memory that was freed back to the system, where the C library can."""
    drop_caches()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def drop(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that no later step reads."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(conf).delete(path, True)
