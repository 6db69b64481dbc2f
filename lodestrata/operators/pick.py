"""One row of each key, by aggregation: partial picks are made before the shuffle, so a key with very many rows is no hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(keys: list[str | Column]) -> list[Column]:
    return [(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)]


def first_by(rows: DataFrame, keys: list[str | Column], order: list[str | Column], *more: Column) -> DataFrame:
    """The row of each key that comes first in ``order`` (nulls first); ``more`` are further aggregates over the key's rows."""
    d = rows.groupBy(*_keyed(keys)).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"), *more)
    return d.select("_row.*", *[c for c in d.columns if not c.startswith("_")])


def last_by(rows: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The row of each key that comes last in ``order``."""
    return rows.groupBy(*_keyed(keys)).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")
