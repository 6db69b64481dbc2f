"""Queries of the evaluation suite: gold rows against a perturbed copy as predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.operators import evalsuite, params, retrieval
from lodestrata.plans.registry import ORACLES, query
from lodestrata.session import table
from lodestrata.storage import stored

KEYS = ["l_orderkey", "l_linenumber"]
_LAST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1"
#: Some records carry a line number that the other side lacks, so that rows are missing and spurious ones occur.
_GOLD_LINE = "l_linenumber + CASE WHEN l_orderkey % 13 = 0 THEN 100 ELSE 0 END"
_PRED_LINE = "l_linenumber + CASE WHEN l_orderkey % 11 = 0 THEN 200 ELSE 0 END"
_GP = f"""
    WITH last AS ({_LAST}),
    g AS (SELECT l_orderkey, {_GOLD_LINE} AS l_linenumber, l_returnflag AS block, l_quantity - 1 AS value, l_linestatus AS unit, [l_partkey, l_suppkey] AS ids FROM last),
    p AS (SELECT l_orderkey, {_PRED_LINE} AS l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN (l_quantity - 1) * 1.2 WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity - 1 END AS value, CASE WHEN l_orderkey % 7 = 0 THEN 'x' ELSE l_linestatus END AS unit,
                 CASE WHEN l_orderkey % 3 = 0 THEN [l_partkey] WHEN l_orderkey % 4 = 0 THEN []::BIGINT[] ELSE [l_partkey, -1] END AS ids FROM last),
    m AS (SELECT g.*, p.l_orderkey IS NOT NULL AS found, p.value AS pv, p.unit AS pu, p.ids AS pids FROM g LEFT JOIN p USING (l_orderkey, l_linenumber))
"""


def _gold_pred(spark, sf_dir):
    li = params.last_by_key(table(spark, sf_dir, "lineitem"), KEYS, "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    ids = F.array("l_partkey", "l_suppkey")
    gold = li.select("l_orderkey", F.expr(_GOLD_LINE).alias("l_linenumber"), F.col("l_returnflag").alias("block"), (F.col("l_quantity") - 1).alias("value"), F.col("l_linestatus").alias("unit"), ids.alias("ids"), F.size(ids).alias("n_citations"))
    value = F.expr("CASE WHEN l_orderkey % 5 = 0 THEN (l_quantity - 1) * 1.2D WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity - 1 END")
    pids = F.expr("CASE WHEN l_orderkey % 3 = 0 THEN array(l_partkey) WHEN l_orderkey % 4 = 0 THEN cast(array() AS array<bigint>) ELSE array(l_partkey, -1L) END")
    pred = li.select("l_orderkey", F.expr(_PRED_LINE).alias("l_linenumber"), value.alias("value"), F.expr("CASE WHEN l_orderkey % 7 = 0 THEN 'x' ELSE l_linestatus END").alias("unit"), pids.alias("ids"), F.size(pids).alias("n_citations"))
    return gold, pred


@query(
    f"""{_GP} SELECT coalesce(block, 'overall') AS block, round(avg(CASE WHEN found THEN abs(value - pv) END), 9) AS mae, round(avg(CASE WHEN found AND value <> 0 THEN abs(value - pv) / abs(value) END), 9) AS mape,
      count(CASE WHEN found THEN abs(value - pv) END) AS n, count(*) FILTER (NOT found) AS missing_from_pred FROM m GROUP BY ROLLUP (block)"""
)
def numeric_metrics(spark, sf_dir):
    return evalsuite.numeric_metrics(evalsuite.matched(*_gold_pred(spark, sf_dir), KEYS).withColumnRenamed("g_block", "block"), "block")


@query(f"{_GP} SELECT coalesce(block, 'overall') AS block, round(avg((unit = pu)::INT), 9) AS accuracy, count(*) AS n FROM m WHERE found GROUP BY ROLLUP (block)")
def unit_metrics(spark, sf_dir):
    return evalsuite.unit_metrics(evalsuite.matched(*_gold_pred(spark, sf_dir), KEYS).withColumnRenamed("g_block", "block"), "block")


@query(
    f"""{_GP}, c AS (SELECT sum(len(list_intersect(list_distinct(ids), list_distinct(pids))))::BIGINT AS tp, sum(len(list_distinct(pids)))::BIGINT AS np, sum(len(list_distinct(ids)))::BIGINT AS ng FROM m WHERE found)
    SELECT tp, np - tp AS fp, ng - tp AS fn, round(tp / np, 9) AS precision, round(tp / ng, 9) AS recall, round(2 * (tp / np) * (tp / ng) / (tp / np + tp / ng), 9) AS f1 FROM c"""
)
def citation_metrics(spark, sf_dir):
    return evalsuite.citation_metrics(evalsuite.matched(*_gold_pred(spark, sf_dir), KEYS), "g_ids", "p_ids")


@query(
    f"""{_GP}, e AS (
      SELECT 'missing_parameter' AS error_type FROM m WHERE NOT found UNION ALL SELECT 'unit_mismatch' FROM m WHERE found AND unit IS DISTINCT FROM pu
      UNION ALL SELECT 'value_mismatch_gt5pct' FROM m WHERE found AND abs(value - pv) > greatest(1e-6, 0.05 * abs(value)) UNION ALL SELECT 'non_numeric_value' FROM m WHERE found AND pv IS NULL
      UNION ALL SELECT 'missing_citation_link' FROM m WHERE found AND len(ids) > 0 AND len(pids) = 0 UNION ALL SELECT 'spurious_parameter' FROM p ANTI JOIN g USING (l_orderkey, l_linenumber))
    SELECT error_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS ratio FROM e GROUP BY 1"""
)
def error_buckets(spark, sf_dir):
    return evalsuite.error_buckets(*_gold_pred(spark, sf_dir), KEYS)


_FIELDS = """
    WITH g AS (SELECT * FROM (SELECT CASE WHEN c_custkey % 9 = 0 THEN 'g' ELSE 'c' END || c_custkey AS c_custkey, c_name AS "name.full", c_mktsegment AS "market.segment", CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey::VARCHAR END AS "market.nation" FROM customer)
               UNPIVOT INCLUDE NULLS (value FOR path IN ("name.full", "market.segment", "market.nation"))),
    p AS (SELECT * FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'p' ELSE 'c' END || c_custkey AS c_custkey, CASE WHEN c_custkey % 4 = 0 THEN lower(c_name) ELSE c_name END AS "name.full", CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS "market.segment",
                   CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE c_nationkey::VARCHAR END AS "market.nation" FROM customer)
               UNPIVOT INCLUDE NULLS (value FOR path IN ("name.full", "market.segment", "market.nation"))),
    j AS (SELECT string_split(path, '.')[1] AS prefix, g.value AS gv, p.value AS pv FROM g FULL JOIN p USING (c_custkey, path)),
    c AS (SELECT coalesce(prefix, 'overall') AS prefix, count(*) FILTER (gv IS NOT DISTINCT FROM pv) AS tp, count(*) FILTER (gv IS DISTINCT FROM pv AND pv IS NOT NULL) AS fp, count(*) FILTER (gv IS DISTINCT FROM pv AND gv IS NOT NULL) AS fn FROM j GROUP BY ROLLUP (prefix))
    SELECT prefix, tp, fp, fn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 9) AS f1 FROM c
"""


def _fields(d, key, name, segment, nation):
    c = F.create_map(F.lit("name.full"), F.expr(name), F.lit("market.segment"), F.expr(segment), F.lit("market.nation"), F.expr(nation))
    return d.select(F.concat(F.expr(key), F.col("c_custkey").cast("string")).alias("c_custkey"), F.explode(c).alias("path", "value"))


@query(_FIELDS)
def field_metrics(spark, sf_dir):
    d = table(spark, sf_dir, "customer")
    g = _fields(d, "CASE WHEN c_custkey % 9 = 0 THEN 'g' ELSE 'c' END", "c_name", "c_mktsegment", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE cast(c_nationkey AS string) END")
    p = _fields(d, "CASE WHEN c_custkey % 10 = 0 THEN 'p' ELSE 'c' END", "CASE WHEN c_custkey % 4 = 0 THEN lower(c_name) ELSE c_name END", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END", "CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE cast(c_nationkey AS string) END")
    return evalsuite.field_metrics(g, p, ["c_custkey", "path"])


_RUNS = """
    WITH q AS (SELECT vec_id AS query_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 20 = 0),
    s AS (SELECT query_id, q.label AS ql, e.vec_id, e.label, round(list_cosine_similarity(e.embedding::DOUBLE[], v), 9) AS score FROM q JOIN embeddings e ON e.vec_id <> query_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s),
    f AS (SELECT query_id, min(rank) FILTER (label = ql) AS first FROM r WHERE rank <= 20 GROUP BY 1),
    o AS (SELECT count(*) AS n_queries, round(avg((coalesce(first, 99) <= 5)::INT), 9) AS hit_at_5, round(avg((coalesce(first, 99) <= 10)::INT), 9) AS hit_at_10, round(avg(coalesce(1.0 / first, 0)), 9) AS mrr FROM f)
"""


def _retrieval(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    q = emb.filter("vec_id % 20 = 0")  # the query set
    runs = retrieval.neighbours(emb, q.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")), 20)
    labels = emb.select("vec_id", "label")
    own = q.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"))
    qrels = runs.join(own, "query_id").join(labels, "vec_id").filter("label = ql").select("query_id", F.col("vec_id").alias("doc_id"))
    every = own.select("query_id", F.lit(-1).cast("bigint").alias("doc_id"))
    return evalsuite.retrieval_metrics(runs.select("query_id", F.col("vec_id").alias("doc_id"), "rank"), qrels.union(every))


@query(f"{_RUNS} SELECT * FROM o")
def retrieval_hit_mrr(spark, sf_dir):
    return _retrieval(spark, sf_dir)


@query(
    f"""{_RUNS.replace("FILTER (label = ql) AS first FROM r WHERE rank <= 20", "FILTER (rank <= 20 AND label = ql AND vec_id > query_id AND vec_id <= query_id + 200) AS first FROM r WHERE query_id IN (SELECT query_id FROM s WHERE label = ql AND vec_id > query_id AND vec_id <= query_id + 200)")}
    SELECT * FROM o"""
)
def retrieval_with_given_judgements(spark, sf_dir):
    """Relevant rows come from the keys and labels alone, so a run can miss them."""
    emb = table(spark, sf_dir, "embeddings")
    q = emb.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"), F.col("label").alias("ql"))
    runs = retrieval.neighbours(emb, q.select("query_id", "query_vec"), 20)
    near = q.select("query_id", "ql", F.explode(F.sequence(F.col("query_id") + 1, F.col("query_id") + 200)).alias("vec_id"))
    qrels = near.join(emb.select("vec_id", "label"), "vec_id").filter("label = ql").select("query_id", F.col("vec_id").alias("doc_id"))
    return evalsuite.retrieval_metrics(runs.select("query_id", F.col("vec_id").alias("doc_id"), "rank"), qrels)


_COST = """
    WITH c AS (SELECT count(event_id) AS n_runs, coalesce(sum(try_cast(json_extract_string(props, '$.k') AS BIGINT)), 0)::BIGINT AS total_tokens, round(coalesce(sum(value), 0), 2) AS total_seconds FROM events)
"""


def _cost(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("tokens", F.get_json_object("props", "$.k")).withColumn("seconds", F.col("value").cast("string"))
    return evalsuite.cost_report(e, "tokens", "seconds", "event_id", digits=2)


@query(f"{_COST} SELECT *, round(total_tokens / n_runs, 2) AS tokens_per_run, round(total_seconds / n_runs, 2) AS seconds_per_run FROM c")
def pipeline_cost_report(spark, sf_dir):
    return _cost(spark, sf_dir)


_GATE = f"""{_RUNS}, k AS (SELECT CASE WHEN hit_at_10 <> 0 THEN hit_at_10 ELSE hit_at_5 END AS recall, mrr FROM o)"""


def _gate(m):
    m = m.withColumn("recall", evalsuite.recall_for_gate(F.col("hit_at_10"), F.col("hit_at_5")))
    return evalsuite.gate(m, [("recall", "ge", 0.6), ("mrr", "ge", 0.2), ("hit_at_5", "le", 0.9)])


@query(
    f"""{_GATE} SELECT 'recall' AS metric, recall AS value, 'ge' AS op, 0.6::DOUBLE AS threshold, recall >= 0.6 AS passed FROM k UNION ALL SELECT 'mrr', mrr, 'ge', 0.2::DOUBLE, mrr >= 0.2 FROM k
    UNION ALL SELECT 'hit_at_5', hit_at_5, 'le', 0.9::DOUBLE, hit_at_5 <= 0.9 FROM o"""
)
def quality_gate(spark, sf_dir):
    return _gate(_retrieval(spark, sf_dir))


@query(
    f"""{_GATE}, cost AS (SELECT count(event_id) AS n_runs FROM events)
    SELECT n_queries, hit_at_5, hit_at_10, o.mrr, n_runs, ((recall < 0.6)::INT + (k.mrr < 0.2)::INT + (hit_at_5 > 0.9)::INT)::BIGINT AS failed_checks FROM o, k, cost"""
)
def report_tables(spark, sf_dir):
    m = stored(_retrieval(spark, sf_dir), "metrics")  # one row, which both the table and the gate read
    failed = _gate(m).agg(F.count_if(~F.col("passed")).alias("failed_checks"))
    return evalsuite.one_row(m, _cost(spark, sf_dir).select("n_runs"), failed).select("n_queries", "hit_at_5", "hit_at_10", "mrr", "n_runs", "failed_checks")


_METHOD = "'engine' AS method"


@query(
    f"""WITH f AS ({_FIELDS}), n AS ({_GP} SELECT coalesce(block, 'overall') AS block, round(avg(CASE WHEN found THEN abs(value - pv) END), 9) AS mae, round(avg(CASE WHEN found AND value <> 0 THEN abs(value - pv) / abs(value) END), 9) AS mape,
      round(avg(CASE WHEN found THEN (unit = pu)::INT END), 9) AS accuracy FROM m GROUP BY ROLLUP (block)),
    c AS ({_GP}, c AS (SELECT sum(len(list_intersect(list_distinct(ids), list_distinct(pids))))::BIGINT AS tp, sum(len(list_distinct(pids)))::BIGINT AS np, sum(len(list_distinct(ids)))::BIGINT AS ng FROM m WHERE found)
      SELECT round(tp / np, 9) AS precision, round(tp / ng, 9) AS recall, round(2 * (tp / np) * (tp / ng) / (tp / np + tp / ng), 9) AS f1 FROM c),
    o AS ({_COST} SELECT round(total_tokens / n_runs, 2) AS tokens_per_run, round(total_seconds / n_runs, 2) AS seconds_per_run FROM c)
    SELECT {_METHOD}, f.precision AS field_precision, f.recall AS field_recall, f.f1 AS field_f1, mae AS numeric_mae, mape AS numeric_mape, accuracy AS unit_accuracy, c.precision AS citation_precision, c.recall AS citation_recall, c.f1 AS citation_f1,
      tokens_per_run, seconds_per_run FROM f, n, c, o WHERE f.prefix = 'overall' AND n.block = 'overall'"""
)
def report_main_table(spark, sf_dir):
    m = evalsuite.matched(*_gold_pred(spark, sf_dir), KEYS)
    by = m.withColumnRenamed("g_block", "block")
    return evalsuite.main_table("engine", field_metrics(spark, sf_dir), evalsuite.numeric_metrics(by, "block"), evalsuite.unit_metrics(by, "block"), evalsuite.citation_metrics(m, "g_ids", "p_ids"), _cost(spark, sf_dir))


_GIVEN = _RUNS.replace(
    "FILTER (label = ql) AS first FROM r WHERE rank <= 20",
    "FILTER (rank <= 20 AND label = ql AND vec_id > query_id AND vec_id <= query_id + 200) AS first FROM r WHERE query_id IN (SELECT query_id FROM s WHERE label = ql AND vec_id > query_id AND vec_id <= query_id + 200)",
)


def _given(spark, sf_dir):
    """Runs, and relevant rows that come from keys and labels alone."""
    emb = table(spark, sf_dir, "embeddings")
    q = emb.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"), F.col("label").alias("ql"))
    runs = retrieval.neighbours(emb, q.select("query_id", "query_vec"), 20)
    near = q.select("query_id", "ql", F.explode(F.sequence(F.col("query_id") + 1, F.col("query_id") + 200)).alias("vec_id"))
    qrels = near.join(emb.select("vec_id", "label"), "vec_id").filter("label = ql").select("query_id", F.col("vec_id").alias("doc_id"))
    return runs.select("query_id", F.col("vec_id").alias("doc_id"), "rank"), qrels


@query(f"""{_GIVEN} SELECT {_METHOD}, count(*) AS queries, round(avg(coalesce(1.0 / first, 0)), 9) AS mrr, {', '.join(f'round(avg((coalesce(first, 99) <= {k})::INT), 9) AS "recall@{k}"' for k in (1, 2, 3, 4, 5))} FROM f""")
def report_recall_table(spark, sf_dir):
    """The k come from the data: the region keys, from 1."""
    return evalsuite.recall_table("engine", *_given(spark, sf_dir), table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).alias("k")))


@query(
    f"""{_GIVEN}, k AS (SELECT hit_at_10 AS recall, mrr, hit_at_5 FROM o) SELECT {_METHOD}, recall >= 0.6 AND mrr >= 0.2 AND hit_at_5 <= 0.9 AS pass, ((recall < 0.6)::INT + (mrr < 0.2)::INT + (hit_at_5 > 0.9)::INT)::BIGINT AS failed_count
      FROM (SELECT CASE WHEN hit_at_10 <> 0 THEN hit_at_10 ELSE hit_at_5 END AS recall, mrr, hit_at_5 FROM o)"""
)
def report_gate_table(spark, sf_dir):
    """The gate on runs against given judgements, which a run can miss."""
    m = evalsuite.retrieval_metrics(*_given(spark, sf_dir))
    m = m.withColumn("recall", evalsuite.recall_for_gate(F.col("hit_at_10"), F.col("hit_at_5")))
    return evalsuite.gate_table("engine", evalsuite.gate(m, [("recall", "ge", 0.6), ("mrr", "ge", 0.2), ("hit_at_5", "le", 0.9)]))


@query(f"SELECT {_METHOD}, prefix, precision, recall, f1, tp, fp, fn FROM ({_FIELDS}) WHERE prefix <> 'overall'")
def report_prefix_table(spark, sf_dir):
    return evalsuite.prefix_table("engine", field_metrics(spark, sf_dir))


@query(f"SELECT {_METHOD}, error_type, n AS count, ratio FROM ({ORACLES['error_buckets']})")
def report_error_table(spark, sf_dir):
    return evalsuite.error_table("engine", evalsuite.error_buckets(*_gold_pred(spark, sf_dir), KEYS))
