"""Reliable intermediate results, held as Parquet in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_local: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only in local mode, where driver and executors are one process."""
    if shared := spark.conf.get("spark.checkpoint.dir", None):
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="lodestrata-"))
    return _local[0]


def _forget() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    _made.clear()
    for path in _local:
        shutil.rmtree(path, ignore_errors=True)


atexit.register(_forget)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{work_dir(spark)}/lodestrata-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def give_back() -> None:
    """Hands what this process has freed back to the system; glibc keeps blocks below 32 MB otherwise, and a driver that once held a model would stay as large."""
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def stored(df: DataFrame, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a scan of it.

    The lineage ends there: a lost executor costs the rerun of its open tasks only. The folders
    are removed when the driver ends.
    """
    spark = df.sparkSession
    give_back()
    path = scratch(spark, name)
    df.write.partitionBy(*keys).parquet(path) if keys else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
