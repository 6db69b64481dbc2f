"""A stored table in hashed buckets of its key, so that a change rewrites only the buckets of the keys it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import store
from lodestrata.storage import stored


class KeyedTable:
    """Parquet under ``path``, partitioned by a hash of ``keys`` into ``buckets``; both stay the same for the table's life.

    A change reads the new rows' buckets, makes their next state by one of the rules of
    :mod:`lodestrata.operators.store`, writes that aside, and then puts it in their place. All rules give
    the same state when a batch is applied twice, so a run that failed in between is mended by running
    it again. A bucket is written by ``files`` tasks, so one key of very many rows is not one task.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, files: int = 1):
        self.spark, self.path, self.keys, self.buckets, self.files = spark, path, keys, buckets, files

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, mode: str) -> None:
        plain = [c for c in rows.columns if c != "_bucket"]
        spread = rows.repartition("_bucket", F.pmod(F.xxhash64(*plain), F.lit(self.files)))
        spread.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        """The first state; an error where there is one already."""
        self._write(self._placed(rows), "errorifexists")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("_bucket")

    def change(self, new: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Puts ``rule(old, new)`` in place of the buckets of the new rows' keys; their numbers are returned. No new rows, no change."""
        batch = stored(self._placed(new), "batch")
        touched = sorted(r[0] for r in batch.select("_bucket").distinct().collect())  # at most one row a bucket
        if not touched:
            return []
        old = self.spark.read.parquet(self.path).filter(F.col("_bucket").isin(touched)).drop("_bucket")
        self._write(stored(self._placed(rule(old, batch.drop("_bucket"))), "next"), "overwrite")
        return touched

    def upsert(self, new: DataFrame, overwrite: tuple[str, ...] = ()) -> list[int]:
        """New values over old ones where they are not null; columns in ``overwrite`` in any case. One new row a key."""
        return self.change(new, lambda old, n: store.upsert_coalesce(old, n, self.keys, overwrite))

    def overwrite(self, new: DataFrame) -> list[int]:
        return self.change(new, lambda old, n: store.upsert_overwrite(old, n, self.keys))

    def insert_ignore(self, new: DataFrame, order: list[str]) -> list[int]:
        return self.change(new, lambda old, n: store.insert_ignore(old, n, self.keys, order))

    def replace(self, new: DataFrame) -> list[int]:
        """All old rows of the new rows' keys go, then the new rows come in."""
        return self.change(new, lambda old, n: store.replace_by_key(old, n, self.keys))

    def update(self, new: DataFrame, column: str) -> list[int]:
        return self.change(new, lambda old, n: store.update_column(old, n, self.keys[0], column))
