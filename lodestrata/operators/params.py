"""Parameter rows: one row per parameter of a record, in order, with its block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.text import blank_to_null, clean, norm_text, strip
from lodestrata.operators.pick import last_by

#: Names of elastic constants (fixed values).
ELASTIC = ["c11", "c12", "c13", "c33", "c44", "c55", "c66", "e", "nu", "g", "k"]
PLASTIC_DOMAINS = ["plastic", "twinning", "damage", "thermal", "numerical"]


def block(domain: Column, canonical: Column) -> Column:
    """elastic or plastic; the domain decides before the name."""
    d = clean(domain)
    return F.when(d == "elastic", "elastic").when(d.isin(PLASTIC_DOMAINS), "plastic").when(clean(canonical).isin(ELASTIC), "elastic").otherwise("plastic")


def block_by_name(domain: Column, canonical: Column) -> Column:
    """As :func:`block`, but an elastic name decides against any domain; enrichment uses this one."""
    return F.when((clean(domain) == "elastic") | clean(canonical).isin(ELASTIC), "elastic").otherwise("plastic")


def explode_registry(docs: DataFrame, key: str = "record_id", registry: str = "registry") -> DataFrame:
    """(key, ord, item, block) from an array of parameter structs; null items are left out, a null or empty array gives no rows."""
    d = docs.select(key, F.posexplode(registry).alias("ord", "item")).filter(F.col("item").isNotNull())
    return d.withColumn("block", block(F.col("item.domain"), F.col("item.canonical_name")))


def block_index(params: DataFrame, key: str = "record_id", order: tuple[str, ...] = ("ord",), block_col: str = "block") -> DataFrame:
    """Running index of each block within a record, from 0."""
    w = Window.partitionBy(key, block_col).orderBy(*order)
    return params.withColumn("block_idx", F.row_number().over(w) - 1)


def legacy_rows(docs: DataFrame, key: str = "record_id", elastic: str = "elastic_constants", plastic: str = "plastic_parameters") -> DataFrame:
    """(key, block, ord, symbol, value, unit, source) of the two legacy blocks, elastic first; symbols fall back to canonical names."""
    parts = []
    for name, col in (("elastic", elastic), ("plastic", plastic)):
        d = docs.select(key, F.lit(name).alias("block"), F.posexplode(col).alias("ord", "p")).filter("p is not null")
        symbol = norm_text(F.coalesce(blank_to_null(F.col("p.symbol")), F.col("p.canonical_name")))
        parts.append(d.select(key, "block", "ord", symbol.alias("symbol"), F.col("p.value").alias("value"), norm_text(F.col("p.unit")).alias("unit"), F.col("p.source").alias("source")))
    return parts[0].unionByName(parts[1])


def last_by_key(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key in the given order: later rows overwrite earlier ones."""
    return last_by(rows, keys, list(order))


def positional_enrich(base: DataFrame, extra: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Left join of enrichment rows by record, block and running index; a non-null enrichment value fills a null one."""
    e = extra.select(*keys, *[F.col(c).alias(f"_{c}") for c in cols])
    out = base.join(e, keys, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in cols else F.col(c) for c in base.columns])


def record_id(record: Column, doi: Column, hint: Column, folder: Column) -> Column:
    """The record's own id, else its DOI, the hinted DOI (both lower-cased), else its folder."""
    return F.coalesce(blank_to_null(record), F.lower(blank_to_null(doi)), F.lower(blank_to_null(hint)), folder)


def symbol_of(item: Column) -> Column:
    return strip(F.coalesce(item["symbol"], F.lit("")))
