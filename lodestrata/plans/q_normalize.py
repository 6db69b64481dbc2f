"""Queries of parameter rows and their normalization, on tables that stand in for extracted records."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import numeric, text
from lodestrata.operators import normalize, params, review
from lodestrata.plans.registry import query
from lodestrata.session import spread, table

UNIT = "CASE event_type WHEN 'click' THEN 'MPa' WHEN 'view' THEN ' gpa ' WHEN 'purchase' THEN 's^-1' ELSE NULL END"
FACTOR = "CASE lower(trim(u)) WHEN 'pa' THEN 1.0 WHEN 'kpa' THEN 1e3 WHEN 'mpa' THEN 1e6 WHEN 'gpa' THEN 1e9 END"
_UNITS = f"""
    WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS v, value AS rv, {UNIT} AS u FROM events),
    f AS (SELECT event_id, event_type, coalesce(v, CASE WHEN event_id % 10 = 0 THEN rv END) AS value, u, {FACTOR} AS f FROM e)
"""


def _units(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("u", F.expr(UNIT)).withColumn("v", F.expr("CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END")).withColumn("rv", F.expr("CASE WHEN event_id % 10 = 0 THEN value END"))
    return e.withColumn("x", normalize.normalize_units(F.col("v"), F.col("u"), F.col("rv"), F.lit(None).cast("string")))


@query(f"{_UNITS} SELECT event_id, value, CASE WHEN value IS NOT NULL AND f IS NOT NULL THEN value * f END AS value_si, CASE WHEN value IS NOT NULL AND f IS NOT NULL THEN 'Pa' END AS unit_si FROM f")
def unit_normalize(spark, sf_dir):
    return _units(spark, sf_dir).select("event_id", "x.value", "x.value_si", "x.unit_si")


@query(
    f"""{_UNITS} SELECT coalesce(event_type, 'total') AS event_type, count(*) FILTER (value IS NOT NULL AND f IS NOT NULL) AS converted, count(*) FILTER (value IS NULL OR f IS NULL) AS skipped
    FROM f GROUP BY ROLLUP (event_type)"""
)
def unit_counters(spark, sf_dir):
    return normalize.unit_counts(_units(spark, sf_dir).withColumn("converted", F.col("x.converted")), "event_type")


@query(f"SELECT event_id, value * CASE lower(trim(u)) WHEN 's^-1' THEN 1.0 WHEN '' THEN 1.0 ELSE {FACTOR} END AS value_si FROM (SELECT event_id, value, coalesce({UNIT}, '') AS u FROM events)")
def gold_units(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("u", F.expr(UNIT))
    return e.select("event_id", normalize.normalize_units(F.col("value"), F.col("u"), F.lit(None), F.lit(""), numeric.GOLD_UNITS)["value_si"].alias("value_si"))


SYMBOL = "['tau0', 'g-0', 'TAU_SAT', 'x', 'h0', 'q', '', 'n'][(p_partkey % 8 + 1)::INT]"
NAME = "['Rate Sensitivity', 'latent hardening coefficient', 'c11', NULL, 'other'][(p_partkey % 5 + 1)::INT]"


def _names(spark, sf_dir):
    d = table(spark, sf_dir, "part")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("p_partkey") % len(xs) + 1).cast("int"))
    return d.withColumn("symbol", pick(["tau0", "g-0", "TAU_SAT", "x", "h0", "q", "", "n"])).withColumn("name", pick(["Rate Sensitivity", "latent hardening coefficient", "c11", None, "other"]))


@query(
    f"""
    WITH d AS (SELECT p_partkey, replace(replace(lower({SYMBOL}), '-', ''), '.', '') AS s, {NAME} AS name FROM part)
    SELECT p_partkey, CASE s WHEN 'tau0' THEN 'crss_initial' WHEN 'g0' THEN 'crss_initial' WHEN 'tau_sat' THEN 'crss_saturation' WHEN 'h0' THEN 'hardening_h0' WHEN 'q' THEN 'latent_ratio_q' WHEN 'n' THEN 'exponent_n'
      ELSE CASE lower(name) WHEN 'rate sensitivity' THEN 'exponent_n' WHEN 'latent hardening coefficient' THEN 'latent_ratio_q' ELSE name END END AS canonical FROM d
    """
)
def canonical_map(spark, sf_dir):
    return _names(spark, sf_dir).select("p_partkey", normalize.canonical_name(F.col("symbol"), F.col("name"), F.lit(None).cast("string")).alias("canonical"))


@query(f"SELECT count(*) AS total, count(*) FILTER (replace(lower({SYMBOL}), '-', '') IN ('tau0', 'g0', 'tau_sat', 'h0', 'q', 'n') OR lower({NAME}) IN ('rate sensitivity', 'latent hardening coefficient')) AS name_normalized FROM part")
def normalizer_counters(spark, sf_dir):
    d = _names(spark, sf_dir)
    after = d.withColumn("name", normalize.canonical_name(F.col("symbol"), F.col("name"), F.lit(None).cast("string")))
    return normalize.change_counts(d.select("p_partkey", "name"), after.select("p_partkey", "name"), ["p_partkey"], ["name"])


DOMAIN = "CASE l_linenumber % 4 WHEN 0 THEN 'elastic' WHEN 1 THEN 'plastic' WHEN 2 THEN NULL ELSE ' Damage' END"
CNAME = "CASE l_partkey % 3 WHEN 0 THEN 'C11' WHEN 1 THEN 'nu' ELSE 'tau' END"
_BLOCK = f"CASE WHEN lower(trim({DOMAIN})) = 'elastic' THEN 'elastic' WHEN lower(trim({DOMAIN})) IN ('plastic', 'damage') THEN 'plastic' WHEN lower({CNAME}) IN ('c11', 'nu') THEN 'elastic' ELSE 'plastic' END"
_BLOCK2 = f"CASE WHEN lower(trim({DOMAIN})) = 'elastic' OR lower({CNAME}) IN ('c11', 'nu') THEN 'elastic' ELSE 'plastic' END"
_ORD = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"


def _blocks(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumn("domain", F.expr(DOMAIN)).withColumn("cname", F.expr(CNAME))
    return d.withColumn("block", params.block(F.col("domain"), F.col("cname"))).withColumn("block2", params.block_by_name(F.col("domain"), F.col("cname")))


@query(f"SELECT l_orderkey, l_partkey, block, (row_number() OVER (PARTITION BY l_orderkey, block ORDER BY {_ORD}) - 1)::INT AS block_idx FROM (SELECT *, {_BLOCK} AS block FROM lineitem)")
def block_index(spark, sf_dir):
    return params.block_index(_blocks(spark, sf_dir), "l_orderkey", tuple(_ORD.split(", "))).select("l_orderkey", "l_partkey", "block", "block_idx")


@query(
    f"""
    WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, block ORDER BY {_ORD}) - 1 AS i FROM (SELECT *, {_BLOCK} AS block FROM lineitem)),
    e AS (SELECT l_orderkey, block, i, l_quantity AS q FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, block ORDER BY {_ORD}) - 1 AS i FROM (SELECT *, {_BLOCK2} AS block FROM lineitem)))
    SELECT b.l_orderkey, b.block, b.i::INT AS block_idx, b.l_partkey, e.q AS evidence FROM b LEFT JOIN e USING (l_orderkey, block, i)
    """
)
def positional_join(spark, sf_dir):
    d, order = _blocks(spark, sf_dir), tuple(_ORD.split(", "))
    base = params.block_index(d, "l_orderkey", order).withColumn("evidence", F.lit(None).cast("double")).select("l_orderkey", "block", "block_idx", "l_partkey", "evidence")
    extra = params.block_index(d, "l_orderkey", order, "block2").select("l_orderkey", F.col("block2").alias("block"), "block_idx", F.col("l_quantity").alias("evidence"))
    return params.positional_enrich(base, extra, ["l_orderkey", "block", "block_idx"], ["evidence"])


_ROLES = """
    WITH r AS (SELECT l_orderkey, list(DISTINCT l_partkey::VARCHAR) FILTER (l_linenumber % 2 = 0) AS a, list(DISTINCT CASE WHEN l_partkey % 50 = 0 THEN 'This Study' ELSE l_partkey::VARCHAR END) FILTER (l_partkey % 3 = 0) AS c,
               list(DISTINCT l_suppkey::VARCHAR) AS g FROM lineitem GROUP BY 1),
    n AS (SELECT l_orderkey, coalesce(a, []) AS a, list_filter(coalesce(c, []), lambda x: lower(x) <> 'this study') AS c, coalesce(c, []) AS raw, g FROM r),
    u AS (SELECT l_orderkey, a, list_filter(c, lambda x: NOT list_contains(a, x)) AS c, len(list_intersect(a, c)) AS overlap, g, list_contains(raw, 'This Study') AS ts FROM n)
"""


def _roles(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    s = lambda c: F.col(c).cast("string")
    g = d.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set(F.when(F.col("l_linenumber") % 2 == 0, s("l_partkey")))).alias("a"),
        F.sort_array(F.collect_set(F.when(F.col("l_partkey") % 3 == 0, F.when(F.col("l_partkey") % 50 == 0, "This Study").otherwise(s("l_partkey"))))).alias("c"),
        F.sort_array(F.collect_set(s("l_suppkey"))).alias("g"),
    )
    return g.select("l_orderkey", normalize.roles(F.col("a"), F.col("c"), F.col("g"), F.lit("no")).alias("r"))


@query(
    f"""{_ROLES} SELECT l_orderkey, len(a)::INT AS adopted, len(c)::INT AS calibration, overlap::INT AS overlap, len(list_filter(g, lambda x: NOT list_contains(a, x) AND NOT list_contains(c, x)))::INT AS residual, ts AS this_study FROM u"""
)
def role_sets(spark, sf_dir):
    r = F.col("r")
    return _roles(spark, sf_dir).select("l_orderkey", F.size(r["adopted"]).alias("adopted"), F.size(r["calibration"]).alias("calibration"), r["overlap"].alias("overlap"), F.size(r["residual"]).alias("residual"), r["this_study"].alias("this_study"))


_KNOWN = "(SELECT p_partkey::VARCHAR AS label FROM part WHERE p_size > 20)"
_IDS = f"{_ROLES}, ids AS (SELECT 'adopted' AS role, unnest(a) AS label FROM u UNION ALL SELECT 'calibration', unnest(c) FROM u)"


def _resolved(spark, sf_dir):
    r = _roles(spark, sf_dir)
    ids = r.select(F.lit("adopted").alias("role"), F.explode("r.adopted").alias("label")).union(r.select(F.lit("calibration"), F.explode("r.calibration")))
    return normalize.resolve(ids, table(spark, sf_dir, "part").filter("p_size > 20").select(F.col("p_partkey").cast("string").alias("label")), [])


@query(f"{_IDS} SELECT role, label, label IN {_KNOWN} AS resolved, count(*) AS n FROM ids GROUP BY ALL")
def resolve_refs(spark, sf_dir):
    return _resolved(spark, sf_dir).groupBy("role", "label", "resolved").agg(F.count("*").alias("n"))


@query(f"{_IDS} SELECT role, count(*) AS total, count(*) FILTER (label IN {_KNOWN}) AS resolved, count(DISTINCT label) FILTER (label NOT IN {_KNOWN})::INT AS n_unresolved FROM ids GROUP BY role")
def resolve_by_role(spark, sf_dir):
    return normalize.resolution_counts(_resolved(spark, sf_dir)).select("role", "total", "resolved", F.size("unresolved_labels").alias("n_unresolved"))


@query("SELECT label, o_orderkey FROM (SELECT o_custkey::VARCHAR AS label, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_custkey % 7 <> 0) WHERE rn = 1")
def reference_map(spark, sf_dir):
    r = table(spark, sf_dir, "orders").select(F.expr("CASE WHEN o_custkey % 7 = 0 THEN '' ELSE cast(o_custkey AS string) END").alias("label"), "o_orderkey")
    return normalize.reference_map(r, "o_orderkey").select("label", "o_orderkey")


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN c_name ELSE o_orderstatus END AS title, coalesce(o_orderkey % 3 = 0 AND c_name IS NOT NULL, false) AS backfilled
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    """
)
def ref_backfill(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.expr("CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END").alias("title"))
    return normalize.backfill(o, table(spark, sf_dir, "customer"), "c_custkey", {"title": "c_name"}).select("o_orderkey", "title", "backfilled")




def _families(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    fam = F.struct(
        F.when(F.col("s_suppkey") % 2 == 1, F.col("s_name")).alias("family_id"), F.concat(F.element_at(F.array(F.lit("Basal <a>"), F.lit("Prismatic-1"), F.lit("x twin")), (F.col("s_suppkey") % 3 + 1).cast("int"))).alias("family_name"),
        F.lit("p d").alias("plane_direction"), F.array().cast("array<struct<system_id:string>>").alias("systems"), (F.col("s_suppkey") % 4).cast("string").alias("num_systems"),
    )
    d = s.groupBy(F.col("s_nationkey").alias("record_id")).agg(F.sort_array(F.collect_list(F.struct("s_suppkey", fam.alias("f")))).alias("x")).select("record_id", F.transform("x", lambda x: x["f"]).alias("slip_families"))
    return normalize.families(d, "slip_families", "slip")


_FAMILIES = """
    WITH s AS (SELECT s_nationkey AS record_id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS o, s_suppkey, s_name, ['Basal <a>', 'Prismatic-1', 'x twin'][(s_suppkey % 3 + 1)::INT] AS fname, (s_suppkey % 4)::INT AS n FROM supplier),
    f AS (SELECT *, replace(replace(lower(fname), ' ', '_'), '-', '_') AS slug FROM s),
    g AS (SELECT *, CASE WHEN s_suppkey % 2 = 1 THEN s_name ELSE 'slip_' || slug END AS family_id FROM f),
    h AS (SELECT *, regexp_replace(replace(replace(lower(family_id), ' ', '_'), '-', '_'), '_{2,}', '_', 'g') AS fkey,
          CASE WHEN contains(slug, 'basal') THEN 'basal_slip' WHEN contains(slug, 'prismatic') THEN 'prismatic_slip' ELSE 'twinning' END AS mechanism FROM g),
    k AS (SELECT *, row_number() OVER (PARTITION BY record_id, fkey ORDER BY o DESC) AS rn, min(o) OVER (PARTITION BY record_id, fkey) AS ord FROM h),
    fam AS (SELECT record_id, ord::INT AS ord, family_id, mechanism, n AS num_systems, fkey, fname FROM k WHERE rn = 1)
"""


@query(f"{_FAMILIES} SELECT record_id, ord, family_id, mechanism, num_systems FROM fam")
def family_systems(spark, sf_dir):
    return _families(spark, sf_dir).select("record_id", "ord", "family_id", "mechanism", "num_systems")


@query(
    f"""{_FAMILIES}, p AS (SELECT c_custkey, c_nationkey AS record_id, CASE c_custkey % 3 WHEN 0 THEN 'basal_slip' WHEN 1 THEN 'prismatic_slip' ELSE 'other' END AS mech FROM customer),
    m AS (SELECT p.c_custkey, arg_min(fam.family_id, ord) AS family_id, arg_min(num_systems, ord) AS n FROM p LEFT JOIN fam ON fam.record_id = p.record_id AND fam.mechanism = p.mech GROUP BY 1)
    SELECT c_custkey, CASE WHEN family_id IS NULL THEN 'global' WHEN n > 0 THEN 'system' ELSE 'family' END AS scope, family_id, CASE WHEN family_id IS NOT NULL THEN 'phase_1' END AS phase_id,
           CASE WHEN n > 0 THEN n WHEN family_id IS NOT NULL THEN 0 END AS system_count FROM m"""
)
def scope_normalize(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("record_id"), F.expr("CASE c_custkey % 3 WHEN 0 THEN 'Basal' WHEN 1 THEN 'prismatic slip' ELSE 'other' END").alias("mech"), F.lit(None).cast("string").alias("family_id"),
        F.lit("").alias("family_name"), F.lit(None).cast("array<string>").alias("system_ids"), F.lit(None).cast("int").alias("system_count"), F.lit("all").alias("scope"), F.lit(None).cast("string").alias("phase_id"),
    ).withColumn("mechanism", normalize.mechanism(F.col("mech")))
    return normalize.normalize_scope(normalize.choose_family(p, _families(spark, sf_dir))).select("c_custkey", "scope", "family_id", "phase_id", "system_count")


_SIGNALS = """
    WITH x AS (
      SELECT d.doc_id, ['tau0', 'n', 'E', 'h0'][(d.doc_id % 4 + 1)::INT] AS symbol, CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE d.n_chars END AS value,
             ['adopted', 'calibrated', 'original'][(d.doc_id % 3 + 1)::INT] AS origin_type, CASE WHEN l.quality = 0 THEN 'low' ELSE 'high' END AS confidence, (d.doc_id % 2)::INT AS n_adopted, (d.doc_id % 7 = 0)::INT AS n_calibration,
             coalesce(l.toxic = 1, false) AS this_study, length(d.text) % 3 > 0 AS evidence
      FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id))
"""


def _signals(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    d = table(spark, sf_dir, "documents").join(lab, "doc_id", "left")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("doc_id") % len(xs) + 1).cast("int"))
    return d.select(
        "doc_id", pick(["tau0", "n", "E", "h0"]).alias("symbol"), F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE n_chars END").alias("value"), pick(["adopted", "calibrated", "original"]).alias("origin_type"),
        F.when(F.col("quality") == 0, "low").otherwise("high").alias("confidence"), (F.col("doc_id") % 2).cast("int").alias("n_adopted"), F.expr("int(doc_id % 7 = 0)").alias("n_calibration"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("this_study"), F.expr("length(text) % 3 > 0").alias("evidence"),
    )


@query(
    f"""{_SIGNALS} SELECT doc_id, unnest(list_filter([CASE WHEN NOT evidence THEN 'missing_evidence' END, CASE WHEN lower(symbol) IN ('tau0', 'n', 'h0') AND value IS NULL THEN 'missing_key_parameter_value' END,
      CASE WHEN origin_type = 'adopted' AND (n_calibration > 0 OR this_study) THEN 'source_conflict_origin_vs_calibration' END, CASE WHEN origin_type = 'calibrated' AND n_adopted > 0 THEN 'source_conflict_origin_vs_adopted' END],
      lambda r: r IS NOT NULL)) AS type FROM x"""
)
def quality_issues(spark, sf_dir):
    return normalize.quality_issues(_signals(spark, sf_dir), ["doc_id"])


@query(
    f"""{_SIGNALS}, r AS (SELECT doc_id, list_filter([CASE WHEN confidence = 'low' OR n_adopted + n_calibration = 0 AND origin_type = 'adopted' THEN 'low_confidence_or_missing_refs' END, CASE WHEN NOT evidence THEN 'missing_evidence' END,
      CASE WHEN origin_type = 'adopted' AND (n_calibration > 0 OR this_study) THEN 'origin_conflict_adopted_vs_calibrated' END, CASE WHEN origin_type = 'calibrated' AND n_adopted > 0 THEN 'origin_conflict_calibrated_vs_adopted' END,
      CASE WHEN lower(symbol) IN ('tau0', 'n', 'h0') AND value IS NULL THEN 'key_parameter_missing_value' END], lambda r: r IS NOT NULL) AS reasons FROM x)
    SELECT doc_id, array_to_string(reasons, '|') AS reasons FROM r WHERE len(reasons) > 0"""
)
def review_queue(spark, sf_dir):
    c = F.col
    r = review.reasons(c("confidence"), c("origin_type"), c("n_adopted"), c("n_calibration"), c("this_study"), c("evidence"), c("symbol"), c("value"))
    return review.queue(_signals(spark, sf_dir).withColumn("reasons", r)).select("doc_id", "reasons")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'r' || c_custkey WHEN 1 THEN 'd' || c_custkey ELSE c_name END AS record_id FROM customer")
def record_ids(spark, sf_dir):
    d = table(spark, sf_dir, "customer")
    k, s = F.col("c_custkey") % 3, F.col("c_custkey").cast("string")
    return d.select("c_custkey", params.record_id(F.when(k == 0, F.concat(F.lit("r"), s)).otherwise(""), F.when(k == 1, F.concat(F.lit("D"), s)), F.lit(None).cast("string"), F.col("c_name")).alias("record_id"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '10.1016/j.abc.' || doc_id ELSE NULL END AS doi, CASE WHEN doc_id % 2 = 0 THEN 'abc' ELSE 'other' END AS journal FROM documents")
def doi_extract(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    cited = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" see doi:10.1016/j.abc."), F.col("doc_id").cast("string"), F.lit(" here"))).otherwise("")
    doi = text.first_doi(F.concat("text", cited))
    return d.select("doc_id", doi.alias("doi"), text.journal_key(doi).alias("journal"))


@query(
    f"""{_FAMILIES}, few AS (SELECT * FROM fam WHERE ord = 0 OR record_id % 2 = 1), one AS (SELECT record_id, min(family_id) AS family_id, min(num_systems) AS n FROM few GROUP BY 1 HAVING count(*) = 1)
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN one.family_id END AS family_id, CASE WHEN c_custkey % 2 = 0 THEN one.n END AS num_systems FROM customer LEFT JOIN one ON one.record_id = c_nationkey"""
)
def only_family(spark, sf_dir):
    """Parameters of all slip systems take the record's family where it has one only; half the records keep theirs all, the others the first."""
    fams = _families(spark, sf_dir).filter("ord = 0 OR record_id % 2 = 1")
    p = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("record_id"), F.lit(None).cast("string").alias("family_id"), F.lit("").alias("family_name"), F.when(F.col("c_custkey") % 2 == 0, "all_slip").otherwise("other").alias("mechanism"))
    return normalize.choose_family(p, fams).select("c_custkey", "family.family_id", "family.num_systems")


_OLDER = """
    WITH x AS (SELECT p_partkey, p_retailprice AS v, ['GPa', ' mpa', 's^-1', 'K', NULL][(p_partkey % 5 + 1)::INT] AS u, p_partkey % 4 > 0 AS numeric FROM part)
"""


def _older(spark, sf_dir):
    c, k = F.col, F.col("p_partkey")
    value = F.when(k % 4 == 0, F.lit('"about 3"')).when(k % 4 == 1, F.concat(F.lit('" '), c("p_retailprice").cast("string"), F.lit('"'))).otherwise(c("p_retailprice").cast("string"))
    unit = F.element_at(F.array(F.lit('"GPa"'), F.lit('" mpa"'), F.lit('"s^-1"'), F.lit('"K"'), F.lit("null")), (k % 5 + 1).cast("int"))
    item = F.concat(F.lit('{"value":'), value, F.lit(',"unit":'), unit, F.lit(',"symbol":"","canonical_name":" c'), k.cast("string"), F.lit(' ","more":{"k":1}}'))
    doc = F.concat(F.lit('{"record_id":"r","elastic_parameters":{"constants":['), item, F.lit(',7],"note":"n"},"plastic_parameters":'), F.when(k % 3 == 0, '{"parameters":5}').otherwise(F.concat(F.lit('{"parameters":['), item, F.lit("]}"))), F.lit("}"))
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")).select("p_partkey", F.try_parse_json(doc).alias("doc"))


@query(
    f"""{_OLDER}, y AS (SELECT *, CASE WHEN numeric THEN CASE p_partkey % 5 WHEN 0 THEN 1e9 WHEN 1 THEN 1e6 WHEN 2 THEN 1.0 WHEN 4 THEN 1.0 END END AS f FROM x)
    SELECT p_partkey, CASE WHEN f IS NULL AND NOT numeric THEN 'about 3' END AS text_value, round((v * f)::DOUBLE, 3) AS value_si, CASE WHEN f IS NOT NULL THEN CASE WHEN p_partkey % 5 = 0 THEN 'Pa' ELSE u END END AS unit_si,
      'c' || p_partkey AS symbol, '7' AS other_item, 'n' AS note, (CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE round((v * f)::DOUBLE, 3) END) AS plastic_si, CASE WHEN p_partkey % 3 = 0 THEN '5' END AS kept FROM y"""
)
def gold_documents(spark, sf_dir):
    """Older records whole, with numbers and SI values in both of their blocks."""
    d = _older(spark, sf_dir).select("p_partkey", normalize.older_document(F.col("doc")).alias("r"))
    at = lambda path, kind="string": F.try_variant_get("r", path, kind)
    first = "$.elastic_parameters.constants[0]"
    return d.select(
        "p_partkey", F.when(at(f"{first}.value", "double").isNull(), at(f"{first}.value")).alias("text_value"), F.round(at(f"{first}.value_SI", "double"), 3).alias("value_si"), at(f"{first}.unit_SI").alias("unit_si"), at(f"{first}.symbol").alias("symbol"),
        at("$.elastic_parameters.constants[1]").alias("other_item"), at("$.elastic_parameters.note").alias("note"), F.round(at("$.plastic_parameters.parameters[0].value_SI", "double"), 3).alias("plastic_si"),
        F.when(F.col("p_partkey") % 3 == 0, at("$.plastic_parameters.parameters")).alias("kept"),
    )
