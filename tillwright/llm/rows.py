"""Small helpers shared by the operators: keys that survive pandas, memory of reused workers, and removal of scratch folders."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager

import pyarrow
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def keyed(df: DataFrame, id_col: str, **columns: str) -> DataFrame:
    """The key as text under ``id`` and the given columns under their new names, nothing else.

    As text a key passes through pandas unchanged, also when it is null or wider than a double.
    """
    return df.select(df[_quoted(id_col)].cast("string").alias("id"), *(df[_quoted(old)].alias(new) for new, old in columns.items()))


def rekeyed(df: DataFrame, like: DataFrame, id_col: str) -> DataFrame:
    """Undo ``keyed``: the key under its own name and type, before the other columns."""
    key = F.col("id").cast(like.schema[id_col].dataType).alias(id_col)
    return df.select(key, *(name for name in df.columns if name != "id"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_kept: list[dict] = []


def kept_by_worker(cache: dict) -> dict:
    """A module's cache that outlives a task, until a task of another operator begins in the same worker."""
    _kept.append(cache)
    return cache


def release_unused() -> None:
    """Drop what other operators keep in a reused worker, and give back what its earlier tasks have freed, where the C library can."""
    if any(_kept):
        for cache in _kept:
            cache.clear()
        gc.collect()  # Spark's workers do it after every task, but for what has been dropped just now
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Hand long rows to Python in smaller batches while an action inside the block runs."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
