"""Evaluation of predictions against gold: fields, numbers, units, citations, retrieval, cost, errors, gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.numeric import float_or_zero, int_or_zero, prf, value_mismatch


def matched(gold: DataFrame, pred: DataFrame, keys: list[str]) -> DataFrame:
    """Gold rows with the prediction of the same key: columns g_* and p_*, and ``found``."""
    g = gold.select(*keys, *[F.col(c).alias(f"g_{c}") for c in gold.columns if c not in keys])
    p = pred.select(*keys, F.lit(True).alias("found"), *[F.col(c).alias(f"p_{c}") for c in pred.columns if c not in keys])
    return g.join(p, keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def with_total(rows: DataFrame, by: str, *aggs: Column) -> DataFrame:
    return rows.rollup(by).agg(*aggs).withColumn(by, F.coalesce(by, F.lit("overall")))


def numeric_metrics(m: DataFrame, by: str, gold: str = "g_value", pred: str = "p_value", digits: int = 9) -> DataFrame:
    """MAE, MAPE (without gold 0) and counts by block and overall; keys without prediction count as missing."""
    e = F.when(F.col("found"), F.abs(F.col(gold) - F.col(pred)))
    share = F.when(F.col(gold) != 0, e / F.abs(F.col(gold)))
    return with_total(m, by, F.round(F.avg(e), digits).alias("mae"), F.round(F.avg(share), digits).alias("mape"), F.count(e).alias("n"), F.count_if(~F.col("found")).alias("missing_from_pred"))


def unit_metrics(m: DataFrame, by: str, digits: int = 9) -> DataFrame:
    return with_total(m.filter("found"), by, F.round(F.avg(F.col("g_unit").eqNullSafe(F.col("p_unit")).cast("int")), digits).alias("accuracy"), F.count("*").alias("n"))


def citation_metrics(m: DataFrame, gold: str, pred: str, digits: int = 9) -> DataFrame:
    """Micro precision, recall and F1 over the id sets of matched rows; null where undefined."""
    g, p = F.array_distinct(F.col(gold)), F.array_distinct(F.col(pred))
    d = m.filter("found").agg(
        F.coalesce(F.sum(F.size(F.array_intersect(g, p))), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.size(F.array_except(p, g))), F.lit(0)).alias("fp"), F.coalesce(F.sum(F.size(F.array_except(g, p))), F.lit(0)).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return d.select("tp", "fp", "fn", F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"), F.round(F.try_divide(2 * precision * recall, precision + recall), digits).alias("f1"))


def field_metrics(gold: DataFrame, pred: DataFrame, keys: list[str], prefix: str = "path", digits: int = 9) -> DataFrame:
    """Precision, recall and F1 of flattened fields (keys, path, value) by first path part and overall.

    Fields null on both sides count as right; one that differs counts against both sides.
    """
    g = gold.select(*keys, F.col("value").alias("gv"))
    p = pred.select(*keys, F.col("value").alias("pv"))
    d = g.join(p, keys, "full")
    same, gold_only, pred_only = F.col("gv").eqNullSafe(F.col("pv")), F.col("gv").isNotNull(), F.col("pv").isNotNull()
    tp, fp, fn = F.count_if(same), F.count_if(~same & pred_only), F.count_if(~same & gold_only)
    out = d.withColumn("prefix", F.split(prefix, "\\.")[0]).rollup("prefix").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")).withColumn("prefix", F.coalesce("prefix", F.lit("overall")))
    precision, recall, f1 = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return out.select("prefix", "tp", "fp", "fn", F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"), F.round(f1, digits).alias("f1"))


def retrieval_metrics(runs: DataFrame, qrels: DataFrame, ks: tuple[int, ...] = (5, 10), digits: int = 9) -> DataFrame:
    """Hit rate at each k and MRR over the queries that both tables hold. runs: query_id, doc_id, rank (from 1); qrels: query_id, doc_id."""
    rel = qrels.select("query_id", "doc_id").distinct().withColumn("rel", F.lit(1))
    d = runs.join(rel.select("query_id").distinct(), "query_id", "left_semi").join(rel, ["query_id", "doc_id"], "left")
    first = d.groupBy("query_id").agg(F.min(F.when(F.col("rel") == 1, F.col("rank"))).alias("first"))
    hits = [F.round(F.avg(F.when(F.col("first") <= k, 1.0).otherwise(0.0)), digits).alias(f"hit_at_{k}") for k in ks]
    return first.agg(F.count("*").alias("n_queries"), *hits, F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), digits).alias("mrr"))


def cost_report(runs: DataFrame, tokens: str, seconds: str, paper: str, digits: int = 6) -> DataFrame:
    """Totals and means per paper of an all-text export; what is no number counts as 0, a mean over no papers is null."""
    t, s, n = F.sum(int_or_zero(F.col(tokens))), F.sum(float_or_zero(F.col(seconds))), F.count(paper)
    d = runs.agg(n.alias("n_runs"), F.coalesce(t, F.lit(0)).alias("total_tokens"), F.round(F.coalesce(s, F.lit(0.0)), digits).alias("total_seconds"))
    return d.withColumn("tokens_per_run", F.round(F.try_divide("total_tokens", "n_runs"), digits)).withColumn("seconds_per_run", F.round(F.try_divide("total_seconds", "n_runs"), digits))


def error_buckets(gold: DataFrame, pred: DataFrame, keys: list[str], digits: int = 9) -> DataFrame:
    """Counts of six error types and their share of all; a key may have several. Columns: value (double), unit, n_citations."""
    m = matched(gold, pred, keys)
    f = F.col("found")
    both = F.col("g_value").isNotNull() & F.col("p_value").isNotNull()
    kinds = F.array_compact(
        F.array(
            F.when(~f, "missing_parameter"), F.when(f & ~F.col("g_unit").eqNullSafe(F.col("p_unit")), "unit_mismatch"), F.when(f & both & value_mismatch(F.col("g_value"), F.col("p_value")), "value_mismatch_gt5pct"),
            F.when(f & ~both, "non_numeric_value"), F.when(f & (F.col("g_n_citations") > 0) & (F.col("p_n_citations") == 0), "missing_citation_link"),
        )
    )
    d = m.select(F.explode(kinds).alias("error_type")).unionByName(pred.join(gold, keys, "left_anti").select(F.lit("spurious_parameter").alias("error_type")))
    out = d.groupBy("error_type").agg(F.count("*").alias("n"))
    return out.withColumn("ratio", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), digits))


def gate(metrics: DataFrame, checks: list[tuple[str, str, float]]) -> DataFrame:
    """One row per check of a one-row metrics table (metric, 'ge' or 'le', threshold), with ``passed``; a missing metric counts as 0."""
    rows = [F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(m), F.lit(0.0)).cast("double").alias("value"), F.lit(op).alias("op"), F.lit(float(t)).alias("threshold")) for m, op, t in checks]
    d = metrics.select(F.inline(F.array(*rows)))
    return d.withColumn("passed", F.when(F.col("op") == "ge", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold")))


def recall_for_gate(at_10: Column, at_5: Column) -> Column:
    """Recall at 10, else (also where it is 0) at 5."""
    return F.when(F.coalesce(at_10, F.lit(0.0)) != 0, at_10).otherwise(at_5)


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    out = frames[0]
    for f in frames[1:]:
        out = out.crossJoin(F.broadcast(f.limit(1)))
    return out


def main_table(method: str, field: DataFrame, numeric: DataFrame, unit: DataFrame, citation: DataFrame, cost: DataFrame) -> DataFrame:
    """The main results of a method in one row, from the overall rows of its metric tables and its cost."""
    overall = lambda d, by: d.filter(F.col(by) == "overall").drop(by)
    parts = [
        overall(field, "prefix").select(*[F.col(c).alias(f"field_{c}") for c in ("precision", "recall", "f1")]), overall(numeric, "block").select(F.col("mae").alias("numeric_mae"), F.col("mape").alias("numeric_mape")),
        overall(unit, "block").select(F.col("accuracy").alias("unit_accuracy")), citation.select(*[F.col(c).alias(f"citation_{c}") for c in ("precision", "recall", "f1")]), cost.select("tokens_per_run", "seconds_per_run"),
    ]
    d = one_row(*parts)
    return d.select(F.lit(method).alias("method"), *d.columns)


def recall_table(method: str, runs: DataFrame, qrels: DataFrame, ks: DataFrame, digits: int = 9) -> DataFrame:
    """Queries, MRR and a column ``recall@k`` for each k of a table (k): the share of queries with a relevant document among the first k.

    The first relevant rank of each query is found once, counted by rank, and those few counts meet all k.
    """
    rel = qrels.select("query_id", "doc_id").distinct().withColumn("rel", F.lit(True))
    d = runs.join(rel.select("query_id").distinct(), "query_id", "left_semi").join(rel, ["query_id", "doc_id"], "left")
    first = d.groupBy("query_id").agg(F.min(F.when(F.col("rel"), F.col("rank"))).alias("first"))
    by_rank = first.groupBy("first").agg(F.count("*").alias("n"))
    all_ks = sorted(r[0] for r in ks.select("k").distinct().collect())  # the report's columns, so few by nature
    total = F.sum("n")
    recall = [F.round(F.coalesce(F.sum(F.when(F.col("first") <= k, F.col("n"))), F.lit(0)) / total, digits).alias(f"recall@{k}") for k in all_ks]
    mrr = F.round(F.coalesce(F.sum(F.col("n") / F.col("first")), F.lit(0.0)) / total, digits).alias("mrr")
    return by_rank.agg(total.alias("queries"), mrr, *recall).select(F.lit(method).alias("method"), "*")


def error_table(method: str, buckets: DataFrame) -> DataFrame:
    """The error types of a method, most frequent first."""
    return buckets.select(F.lit(method).alias("method"), "error_type", F.col("n").alias("count"), "ratio").orderBy(F.desc("count"), "error_type")


def prefix_table(method: str, field: DataFrame) -> DataFrame:
    """The field metrics of a method by prefix, in the order of the prefixes."""
    return field.filter("prefix <> 'overall'").select(F.lit(method).alias("method"), "prefix", "precision", "recall", "f1", "tp", "fp", "fn").orderBy("prefix")


def gate_table(method: str, checks: DataFrame) -> DataFrame:
    """Whether a method passes all checks, and how many it fails."""
    failed = F.count_if(~F.col("passed"))
    return checks.agg(F.lit(method).alias("method"), (failed == 0).alias("pass"), failed.alias("failed_count"))


def unit_table(method: str, unit: DataFrame) -> DataFrame:
    """Unit accuracy of a method by block, in the order of the blocks."""
    return unit.filter("block <> 'overall'").select(F.lit(method).alias("method"), "block", "accuracy", "n").orderBy("block")
