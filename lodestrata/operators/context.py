"""Choosing and packing the parts of a document within a budget of characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.text import catalog_line

#: Words that mark relevant sections and tables (fixed values).
SECTION_WORDS = [
    "material", "experimental", "method", "simulation", "model", "finite element", "fem", "numerical", "constitutive", "processing", "heat treatment", "rolling", "forging",
    "anneal", "solution", "aging", "quench", "cold", "hot", "setup", "procedure", "testing",
]
TABLE_WORDS = [
    "composition", "chemical", "alloy", "wt", "weight percent", "parameter", "constant", "johnson", "cook", "jc", "model", "simulation", "boundary", "mesh", "element",
    "strain rate", "temperature",
]


def part(kind: str, name: Column, text: Column, score: Column | None = None) -> Column:
    head = F.concat(F.lit(f"\n\n=== {kind}: "), name)
    head = F.concat(head, F.lit(" (score="), score.cast("string"), F.lit(")")) if score is not None else head
    return F.concat(head, F.lit(" ===\n"), text)


def budget_inclusive(parts: DataFrame, by: str, order: list[str], length: str, most: int) -> DataFrame:
    """Parts whose predecessors stay within the budget: the one that passes it is still taken."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum(length).over(w), F.lit(0))).filter(F.col("before") <= most)


def budget_strict(parts: DataFrame, by: str, order: list[str], length: str, most: int) -> DataFrame:
    """Parts up to the first that would pass the budget."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return parts.withColumn("total", F.sum(length).over(w)).filter(F.col("total") <= most)


def budget_sections_then_tables(parts: DataFrame, by: str, kind: str, order: list[str], length: str, most: int) -> DataFrame:
    """Strict budget over sections; the tables share what the kept sections left."""
    sections = budget_strict(parts.filter(F.col(kind) == "section"), by, order, length, most)
    used = sections.groupBy(by).agg(F.max("total").alias("_used"))
    tables = parts.filter(F.col(kind) == "table").join(used, by, "left")
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    tables = tables.withColumn("total", F.coalesce("_used", F.lit(0)) + F.sum(length).over(w)).filter(F.col("total") <= most).drop("_used")
    return sections.unionByName(tables)


def budget_first_table(parts: DataFrame, by: str, kind: str, order: list[str], length: str, most: int) -> DataFrame:
    """Inclusive budget over sections, then tables, but the first table always comes along."""
    first = Window.partitionBy(by, kind).orderBy(*order)
    w = Window.partitionBy(by).orderBy(F.when(F.col(kind) == "section", 0).otherwise(1), *order).rowsBetween(Window.unboundedPreceding, -1)
    d = parts.withColumn("before", F.coalesce(F.sum(length).over(w), F.lit(0))).withColumn("_n", F.row_number().over(first))
    return d.filter((F.col("before") <= most) | (F.col(kind) == "table") & (F.col("_n") == 1)).drop("_n")


def selected_or_first(parts: DataFrame, by: list[str], order: list[str], selected: str, first: int) -> DataFrame:
    """The selected parts of each group; where none is selected, its first ones."""
    whole = Window.partitionBy(*by)
    rn = F.row_number().over(whole.orderBy(*order))
    d = parts.withColumn("_any", F.max(F.when(F.col(selected), 1).otherwise(0)).over(whole)).withColumn("_rn", rn)
    return d.filter(F.col(selected) | (F.col("_any") == 0) & (F.col("_rn") <= first)).drop("_any", "_rn")


def relevant_section(score: Column, name: Column) -> Column:
    return (score > 0) | F.contains(F.lower(name), F.lit("abstract"))


def catalog(parts: DataFrame, by: str, name: str, text: str, order: list[str]) -> DataFrame:
    """One text per group: a line for each part, in order."""
    d = parts.select(by, F.struct(*order, catalog_line(F.col(name), F.col(text)).alias("line")).alias("x"))
    return d.groupBy(by).agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["line"]), "\n").alias("catalog"))


def context_text(parts: DataFrame, by: str, order: list[str], text: str) -> DataFrame:
    """The kept parts of each group in one text; a group without parts has no row, and no model is called for it."""
    d = parts.select(by, F.struct(*order, F.col(text).alias("t")).alias("x"))
    return d.groupBy(by).agg(F.trim(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["t"]), "\n")).alias("context"))
