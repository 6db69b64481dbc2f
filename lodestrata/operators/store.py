"""Table semantics as pure functions: the old state and new rows give the next state, which the caller writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.numbering import numbered
from lodestrata.operators.pick import first_by, last_by


def latest(new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last new row of each key."""
    return last_by(new, keys, order)


def upsert_coalesce(old: DataFrame, new: DataFrame, keys: list[str], overwrite: tuple[str, ...] = ()) -> DataFrame:
    """New values over old ones, where they are not null; columns in ``overwrite`` take the new value even so. One row of ``new`` per key."""
    n = new.select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in old.columns if c not in keys])
    d = old.join(n, keys, "full")
    return d.select(*[F.col(c) if c in keys else (F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)) if c in overwrite else F.coalesce(f"_{c}", c)).alias(c) for c in old.columns])


def upsert_overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new, keys, "left_anti").unionByName(new.select(*old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Old rows stay; of the new ones the first of each new key comes in."""
    return old.unionByName(first_by(new, keys, order).join(old, keys, "left_anti").select(*old.columns))


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All old rows of the new rows' keys go, then the new rows come in; a rerun changes nothing."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.select(*old.columns))


def append_numbered(old: DataFrame, new: DataFrame, ident: str, order: list[str]) -> DataFrame:
    """Appends rows with ids that go on from the largest, in the given order; unique and without gaps."""
    top = F.broadcast(old.agg(F.coalesce(F.max(ident), F.lit(0)).alias("_top")))
    out = numbered(new, list(order), "_nth").crossJoin(top).withColumn(ident, (F.col("_top") + F.col("_nth")).cast(old.schema[ident].dataType))
    return old.unionByName(out.select(*old.columns))


def update_column(old: DataFrame, new: DataFrame, key: str, col: str) -> DataFrame:
    """Sets a column by id; rows without an update keep their value."""
    n = new.select(key, F.lit(True).alias("_hit"), F.col(col).alias("_v"))
    return old.join(n, key, "left").select(*[F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(c)).alias(c) if c == col else F.col(c) for c in old.columns])


def evolve(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rows in a table's columns: missing ones are null, unknown ones are left out."""
    return rows.select(*[F.col(c).cast(t).alias(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key no parent has; null keys are none."""
    c = child.filter(F.col(child_key).isNotNull())
    return c.join(parent.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_anti")


def reference_links(params: DataFrame, refs: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, label, doi) of parameters' reference labels that a reference with label and DOI resolves. refs: key, reference_id, label, doi."""
    label = F.coalesce(F.nullif(F.col("reference_id"), F.lit("")), F.col("label"))
    known = refs.select(key, label.alias("label"), "doi").filter("label <> '' and doi <> ''").dropDuplicates([key, "label"])
    return params.join(known, [key, "label"])
