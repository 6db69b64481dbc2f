"""Human-review queue and corpus insight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import blank_to_null, clean, strip
from lodestrata.operators.normalize import REVIEW_SYMBOLS


def low_confidence(confidence: Column, origin: Column, n_ids: Column) -> Column:
    return (clean(confidence) == "low") | (n_ids == 0) & F.coalesce(origin.isin("adopted", "adopted_then_calibrated"), F.lit(False))


def reasons(confidence: Column, origin: Column, n_adopted: Column, n_calibration: Column, this_study: Column, evidence: Column, symbol: Column, value: Column) -> Column:
    """Why a parameter needs review, in fixed order; empty where it needs none."""
    o = strip(F.coalesce(origin, F.lit("")))
    return F.array_compact(
        F.array(
            F.when(low_confidence(confidence, origin, n_adopted + n_calibration), "low_confidence_or_missing_refs"), F.when(~evidence, "missing_evidence"),
            F.when((o == "adopted") & ((n_calibration > 0) | this_study), "origin_conflict_adopted_vs_calibrated"), F.when((o == "calibrated") & (n_adopted > 0), "origin_conflict_calibrated_vs_adopted"),
            F.when(clean(symbol).isin(REVIEW_SYMBOLS) & (F.coalesce(value.cast("string"), F.lit("")) == ""), "key_parameter_missing_value"),
        )
    )


def queue(rows: DataFrame, reason_list: str = "reasons") -> DataFrame:
    """Rows with a reason, their reasons joined by '|'."""
    return rows.filter(F.size(reason_list) > 0).withColumn(reason_list, F.array_join(reason_list, "|"))


def most_common(rows: DataFrame, value: str, order: list[str], k: int) -> DataFrame:
    """The k most frequent values; among equals, the one first seen comes first."""
    return rows.groupBy(value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("_first")).orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def distribution(rows: DataFrame, *values: str, default: str = "unknown") -> DataFrame:
    """Counts by the first filled of several columns."""
    v = F.coalesce(*[blank_to_null(strip(F.col(c))) for c in values], F.lit(default))
    return rows.groupBy(v.alias("bucket")).agg(F.count("*").alias("n"))


def round_robin(rows: DataFrame, stratum: str, order: list[str], n: int) -> DataFrame:
    """n rows taken from the strata in turn, larger strata first.

    Within a stratum rows go by ``order``, a key or hash order, so that reruns agree. Strata of one
    size go by their first row.
    """
    from pyspark.sql.window import Window

    sizes = rows.groupBy(stratum).agg(F.count("*").alias("_size"), F.min(F.struct(*order)).alias("_first"))
    # No stratum gives more than n rows; the filter lets each task keep its own first n before the shuffle.
    first = rows.withColumn("pick_round", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).filter(F.col("pick_round") <= n)
    sizes = sizes.withColumnRenamed(stratum, "_stratum")
    d = first.join(sizes, first[stratum].eqNullSafe(sizes["_stratum"])).drop("_stratum")
    return d.orderBy("pick_round", F.desc("_size"), "_first").limit(n).drop("_size", "_first")


def pilot(rows: DataFrame, stratum: str, order: list[str], n: int, by: str) -> DataFrame:
    """The rows of ``round_robin`` in the order in which they are handed out, by their key."""
    return round_robin(rows, stratum, order, n).orderBy(by)


def seed_record(meta: DataFrame, folder: str, journal: str) -> DataFrame:
    """Adds the annotation metadata of a pilot label."""
    note = F.struct(F.lit("pilot").alias("stage"), F.lit("to_annotate").alias("status"), F.lit("model_prediction").alias("seed_source"), F.col(folder).alias("paper_dir"), F.col(journal).alias("journal_key"))
    return meta.withColumn("annotation_metadata", note)


def markdown_summary(counts: DataFrame, key: str, n: str, title: str) -> DataFrame:
    """One text: a title and a line per key, most frequent first."""
    x = F.struct((-F.col(n)).alias("o"), F.col(key).alias("k"), F.col(n).alias("n"))
    lines = F.transform(F.sort_array(F.collect_list(x)), lambda r: F.concat(F.lit("- "), r["k"], F.lit(": "), r["n"].cast("string")))
    return counts.agg(F.concat(F.lit(f"# {title}\n\n"), F.array_join(lines, "\n")).alias("report"))
