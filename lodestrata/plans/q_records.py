"""Queries of records, references, documents with nested sections, sources and sinks."""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import functions as F

from lodestrata.functions import nested, numeric, text
from lodestrata.operators import documents, normalize, params, retrieval, review
from lodestrata.operators.numbering import numbered
from lodestrata.plans import lifecycle, q_normalize
from lodestrata.plans.registry import query
from lodestrata.session import table
from lodestrata.sources import readers, rest, sinks
from lodestrata.storage import scratch

_WS = r"[ \t\n\x0b\x0c\r]"


@query("SELECT s_suppkey, '10.1016/' || s_name AS doi, CASE WHEN s_suppkey % 2 = 0 THEN '10.1016/' || s_name END AS strict FROM supplier")
def folder_dois(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    name = F.concat(F.lit("10.1016_"), F.col("s_name"))
    return s.select("s_suppkey", text.doi_from_folder(name).alias("doi"), text.doi_from_folder(F.when(F.col("s_suppkey") % 2 == 0, name).otherwise(F.concat(F.lit("x_"), name)), strict=True).alias("strict"))


@query("SELECT c_custkey, try_cast(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT) AS n, try_cast(nullif(regexp_extract(c_mktsegment, '(\\d+)', 1), '') AS BIGINT) AS none FROM customer")
def reference_numbers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.ref_number(F.col("c_name")).alias("n"), text.ref_number(F.col("c_mktsegment")).alias("none"))


@query(
    """SELECT p_partkey, concat_ws(' ', nullif(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END, ''), p_brand, CASE WHEN p_partkey % 3 <> 0 THEN '(' || p_size || ')' END, CASE WHEN p_partkey % 5 <> 0 THEN p_type END) AS citation FROM part"""
)
def bibliographic_strings(spark, sf_dir):
    k = F.col("p_partkey")
    c = text.bibliographic(F.when(k % 4 == 0, "").otherwise(F.col("p_name")), F.col("p_brand"), F.when(k % 3 != 0, F.col("p_size")).otherwise(0), F.when(k % 5 != 0, F.col("p_type")))
    return table(spark, sf_dir, "part").select("p_partkey", c.alias("citation"))


@query(
    """WITH x AS (SELECT *, CASE WHEN l_orderkey % 6 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN l_extendedprice * 1.0000005 WHEN l_orderkey % 3 = 1 THEN l_extendedprice + 1 ELSE l_extendedprice END AS b FROM lineitem)
    SELECT (CASE WHEN b IS NULL THEN false ELSE abs(l_extendedprice - b) <= 1e-9 + 1e-6 * abs(b) END) AS equal, count(*) AS n FROM x GROUP BY 1"""
)
def almost_equal_values(spark, sf_dir):
    b = F.expr("CASE WHEN l_orderkey % 6 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN l_extendedprice * 1.0000005D WHEN l_orderkey % 3 = 1 THEN l_extendedprice + 1 ELSE l_extendedprice END")
    return table(spark, sf_dir, "lineitem").groupBy(numeric.almost_equal(F.col("l_extendedprice"), b).alias("equal")).agg(F.count("*").alias("n"))


@query(rf"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE nullif(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g'), '') END AS x FROM documents")
def numbers_or_texts(spark, sf_dir):
    x = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit(".0"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", numeric.number_or_text(x).alias("x"))


_TEMPLATE = 'Answer with {"k": "", "name": "", "tags": [""], "meta": {"a": "", "b": ""}} only.'
_SQL_RECORD = "CASE WHEN event_id % 4 = 0 THEN '{\"k\":\"' || event_id || '\",\"tags\":[\"' || event_type || '\"],\"meta\":{\"a\":\"x\"}}' WHEN event_id % 4 = 1 THEN '{\"k\":null,\"tags\":7,\"meta\":[]}' WHEN event_id % 4 = 2 THEN props ELSE 'no json' END"


def _records(spark, sf_dir):
    doc = "CASE WHEN event_id % 4 = 0 THEN concat('{\"k\":\"', event_id, '\",\"tags\":[\"', event_type, '\"],\"meta\":{\"a\":\"x\"}}') WHEN event_id % 4 = 1 THEN '{\"k\":null,\"tags\":7,\"meta\":[]}' WHEN event_id % 4 = 2 THEN props ELSE 'no json' END"
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("record_id"), F.expr(doc).alias("doc"))


@query(
    f"""
    WITH d AS (SELECT event_id AS record_id, {_SQL_RECORD} AS doc FROM events),
    j AS (SELECT record_id, CASE WHEN json_valid(doc) AND json_type(doc) = 'OBJECT' THEN doc::JSON END AS doc FROM d),
    p AS (SELECT record_id, path, want, CASE WHEN doc IS NULL THEN NULL ELSE json_type(doc, '$.' || path) END AS kind FROM j, (VALUES ('k', 'x'), ('name', 'x'), ('tags', 'ARRAY'), ('meta', 'OBJECT')) v(path, want))
    SELECT record_id, path, CASE WHEN kind IS NULL THEN 'missing' WHEN want = 'ARRAY' THEN 'not a list' ELSE 'not an object' END AS problem FROM p WHERE kind IS NULL OR want <> 'x' AND kind <> want
    """
)
def record_problems(spark, sf_dir):
    return nested.problems(_records(spark, sf_dir), nested.skeleton(_TEMPLATE))


@query(
    """SELECT event_id AS record_id, CASE WHEN event_id % 4 = 0 THEN event_id::VARCHAR WHEN event_id % 4 = 2 THEN json_extract_string(props, '$.k') END AS k, NULL::VARCHAR AS name,
      (CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END)::INT AS n_tags, CASE WHEN event_id % 4 = 0 THEN 'x' END AS a FROM events"""
)
def coerced_records(spark, sf_dir):
    d = _records(spark, sf_dir).withColumn("r", nested.coerce(F.col("doc"), nested.skeleton(_TEMPLATE)))
    return d.select("record_id", "r.k", "r.name", F.size("r.tags").alias("n_tags"), F.col("r.meta.a").alias("a"))


@query("SELECT doc_id, '{\"a\": {\"c\": ' || doc_id || '}, \"l\": [{\"n\": \"' || coalesce(lang, '') || '\"}, 2]}' AS doc FROM documents")
def internal_keys_stripped(spark, sf_dir):
    raw = F.concat(F.lit('{"_run":{"x":1},"a":{"_b":2,"c":'), F.col("doc_id").cast("string"), F.lit('},"l":[{"_k":0,"n":"'), F.coalesce("lang", F.lit("")), F.lit('"},2]}'))
    return nested.strip_internal(table(spark, sf_dir, "documents").select("doc_id", raw.alias("doc")))


@query("SELECT o_orderkey, o_orderstatus AS origin_type, o_totalprice AS page FROM orders")
def source_keys_dropped(spark, sf_dir):
    s = F.struct(F.col("o_orderstatus").alias("origin_type"), F.col("o_totalprice").alias("page"), *[F.col("o_orderpriority").alias(c) for c in normalize.SOURCE_EXTRAS])
    return table(spark, sf_dir, "orders").select("o_orderkey", nested.drop_keys(s, *normalize.SOURCE_EXTRAS).alias("s")).select("o_orderkey", "s.*")


_BLOCK = q_normalize._BLOCK


@query(f"SELECT l_orderkey AS record_id, l_partkey AS id, {_BLOCK} AS block, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1)::INT AS ord FROM lineitem")
def registry_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.expr(q_normalize.DOMAIN).alias("domain"), F.expr(q_normalize.CNAME).alias("canonical_name"), F.col("l_partkey").alias("id"))
    d = li.groupBy(F.col("l_orderkey").alias("record_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", item.alias("i")))).alias("x"))
    d = d.select("record_id", F.transform("x", lambda x: x["i"]).alias("registry"))
    empty = d.limit(0).select("record_id", F.col("registry"))
    return params.explode_registry(d.union(empty)).select("record_id", "item.id", "block", "ord")


@query(
    """SELECT s_suppkey AS record_id, 'elastic' AS block, 0 AS ord, lower(s_name) AS symbol, s_acctbal AS value, 'gpa' AS unit FROM supplier
    UNION ALL SELECT s_suppkey, 'plastic', 0, 'tau 0', s_acctbal + 1, '' FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'plastic', 2, 'h', s_nationkey::DOUBLE, 'mpa' FROM supplier WHERE s_suppkey % 2 = 0"""
)
def legacy_parameter_rows(spark, sf_dir):
    item = lambda symbol, name, value, unit: F.struct(symbol.cast("string").alias("symbol"), name.cast("string").alias("canonical_name"), value.cast("double").alias("value"), unit.cast("string").alias("unit"), F.lit("x").alias("source"))
    none = F.lit(None)
    el = F.array(item(F.lit(""), F.col("s_name"), F.col("s_acctbal"), F.lit(" GPa ")))
    pl = F.array(item(F.lit("Tau  0"), F.lit("x"), F.col("s_acctbal") + 1, none), F.lit(None).cast("struct<symbol:string,canonical_name:string,value:double,unit:string,source:string>"), item(none, F.lit("H"), F.col("s_nationkey"), F.lit("MPa")))
    d = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("record_id"), el.alias("elastic_constants"), F.when(F.col("s_suppkey") % 2 == 0, pl).alias("plastic_parameters"))
    return params.legacy_rows(d).drop("source")


@query(
    rf"""SELECT doc_id, coalesce(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') <> '', false) OR doc_id % 3 = 0 AS evidence, doc_id % 3 = 0 AS by_page, coalesce(lang <> '', false) AS by_kind FROM documents"""
)
def evidence_flags(spark, sf_dir):
    none = F.lit(None).cast("string")
    page = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id"))
    e = normalize.has_evidence
    return table(spark, sf_dir, "documents").select("doc_id", e(F.col("text"), none, none, none, page).alias("evidence"), e(F.lit("  "), none, F.lit(""), none, page).alias("by_page"), e(none, none, F.col("lang"), none, none).alias("by_kind"))


_ESC = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    rf"""SELECT o_orderkey, 'Order ' || o_orderkey AS xml_title, CASE WHEN o_orderkey % 2 = 0 THEN '10.1016/x.' || o_orderkey ELSE '10.1000/' || o_orderkey END AS xml_doi, o_orderpriority AS first_author, 2::INT AS n_authors, o_clerk AS xml_journal,
      extract('year' FROM o_orderdate)::INT AS xml_year FROM (SELECT *, o_orderstatus AS o_clerk FROM orders)"""
)
def xml_metadata(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    doi = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("<prism:doi> 10.1016/x."), k, F.lit("</prism:doi>"))).otherwise(F.concat(F.lit("<link>doi:10.1000/"), k, F.lit("</link>")))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    a = tag("dc:creator", F.col("o_orderpriority"))
    xml = F.concat(tag("dc:title", F.concat(F.lit("Order\n "), k)), doi, a, tag("dc:creator", F.lit("B")), a, tag("prism:publicationName", F.col("o_orderstatus")), tag("prism:coverDate", F.col("o_orderdate").cast("string")))
    d = normalize.metadata_from_xml(table(spark, sf_dir, "orders").select("o_orderkey", xml.alias("xml")))
    return d.select("o_orderkey", "xml_title", "xml_doi", F.get("xml_authors", F.lit(0)).alias("first_author"), F.size("xml_authors").alias("n_authors"), "xml_journal", "xml_year")


@query(f"{q_normalize._ROLES}, x AS (SELECT l_orderkey, list_distinct(list_concat(list_concat(a, c), list_filter(g, lambda x: NOT list_contains(a, x) AND NOT list_contains(c, x)))) AS ids FROM u) SELECT l_orderkey, len(ids)::INT AS n, array_to_string(list_sort(ids), ',') AS ids FROM x")
def role_ids(spark, sf_dir):
    d = q_normalize._roles(spark, sf_dir).withColumn("ids", normalize.all_ids(F.col("r")))
    return d.select("l_orderkey", F.size("ids").alias("n"), F.array_join(F.array_sort("ids"), ",").alias("ids"))


@query("SELECT c_custkey, 'pilot' AS stage, 'to_annotate' AS status, 'model_prediction' AS seed_source, c_name AS paper_dir, c_mktsegment AS journal_key FROM customer")
def seed_records(spark, sf_dir):
    return review.seed_record(table(spark, sf_dir, "customer"), "c_name", "c_mktsegment").select("c_custkey", "annotation_metadata.*")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name LIMIT 25")
def first_keys(spark, sf_dir):
    return readers.head_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", 25)


@query("SELECT c_custkey, c_name FROM customer")
def all_keys(spark, sf_dir):
    return readers.head_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", 0)


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def predicted_records(spark, sf_dir):
    return readers.with_prediction(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query(rf"SELECT doc_id, nullif(regexp_replace(regexp_replace(split_part(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g'), chr(10), 1), '^#+', ''), '^{_WS}+|{_WS}+$', '', 'g'), '') AS title FROM documents")
def first_line_titles(spark, sf_dir):
    return readers.titled(table(spark, sf_dir, "documents")).select("doc_id", "title")


@query(
    """
    WITH f AS (SELECT o_custkey AS journal, o_orderstatus AS volume, o_orderkey, count(*) OVER w AS n, first_value(o_orderkey) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS first FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderstatus)),
    h AS (SELECT DISTINCT journal, volume, n, first FROM f)
    SELECT c_custkey, s AS volume, CASE WHEN c_custkey % 4 = 0 THEN 'own' ELSE '10.1/' || h.first END AS doi, CASE WHEN c_custkey % 4 = 0 THEN 'own' WHEN h.n = 1 THEN '10.1/' || h.first END AS single
    FROM customer CROSS JOIN (VALUES ('F'), ('O')) v(s) LEFT JOIN h ON h.journal = c_custkey AND h.volume = s
    """
)
def reference_dois(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    found = o.select(F.col("o_custkey").cast("string").alias("journal"), F.col("o_orderstatus").alias("volume"), F.lit("1999").alias("year"), F.lit(None).cast("string").alias("article_number"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("10.1/"), F.col("o_orderkey").cast("string")).alias("doi"))
    refs = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_custkey").cast("string").alias("journal"), F.explode(F.array(F.lit("F"), F.lit("O"))).alias("volume"), F.lit("1999").alias("year"), F.lit(None).cast("string").alias("article_number"),
        F.when(F.col("c_custkey") % 4 == 0, "own").alias("doi"),
    )
    one = documents.fill_dois(refs, found, only_single=True).select("c_custkey", "volume", F.col("doi").alias("single"))
    return documents.fill_dois(refs, found).select("c_custkey", "volume", "doi").join(one, ["c_custkey", "volume"])


def _nested_xml(spark, sf_dir):
    """Whole documents as XML: an abstract, a section per line with a table, a section inside it, and a reference that has no number."""
    d = table(spark, sf_dir, "documents")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = "<tr><td>a</td><td>b <ce:cross-ref refid=\"bib2\">x</ce:cross-ref></td></tr><tr><td>1</td></tr>"
    one = lambda x, i: F.concat(
        F.lit("<ce:section><ce:section-title>S"), i.cast("string"), F.lit("</ce:section-title><ce:section><ce:section-title>Inner</ce:section-title><ce:para>in ([1]; [2])</ce:para></ce:section><ce:para>"), x,
        F.lit(' <ce:cross-ref refid="bib0002">x</ce:cross-ref>, <ce:cross-ref refid="none">[7]</ce:cross-ref></ce:para><ce:table><ce:caption>C'), i.cast("string"), F.lit(f"</ce:caption>{row}</ce:table></ce:section>"),
    )
    secs = F.array_join(F.transform(F.split(esc(F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\[\]()]", " ")), "\n"), one), "")
    bib = F.lit('<ce:bib-reference id="bib0002"><ce:title>R</ce:title><ce:doi>10.1/r</ce:doi></ce:bib-reference>')
    return d.select("doc_id", F.concat(F.lit("<doc><dc:title>D</dc:title><ce:abstract><ce:para>A "), F.col("doc_id").cast("string"), F.lit("</ce:para><ce:para>B</ce:para></ce:abstract>"), secs, bib, F.lit("</doc>")).alias("xml"))


_LINES = rf"""
    WITH d AS (SELECT doc_id, string_split(regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\[\]()]', ' ', 'g'), chr(10)) AS x FROM documents WHERE text IS NOT NULL),
    l AS (SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS x FROM d),
    p AS (SELECT doc_id, i, trim(trim(regexp_replace(x, '{_WS}+', ' ', 'g')) || ' [2,7]') AS para, '| a | b [2] |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 |  |' AS md FROM l)
"""


@query(
    rf"""{_LINES}, s AS (
      SELECT doc_id, 'section' AS kind, (2 * i - 1)::INT AS ord, '## S' || (i - 1) || chr(10) || chr(10) || para || chr(10) || chr(10) || '### Table ' || i || chr(10) || '**Caption:** C' || (i - 1) || chr(10) || chr(10) || md AS content FROM p
      UNION ALL SELECT doc_id, 'section', (2 * i)::INT, '## Inner' || chr(10) || chr(10) || 'in [1,2]' FROM p
      UNION ALL SELECT doc_id, 'abstract', 0, '# Abstract' || chr(10) || chr(10) || 'A ' || doc_id || chr(10) || chr(10) || 'B' FROM d
      UNION ALL SELECT doc_id, 'table_md', i::INT, '**Caption:** C' || (i - 1) || chr(10) || chr(10) || md FROM p)
    SELECT * FROM s"""
)
def document_sections(spark, sf_dir):
    return documents.parse_documents(_nested_xml(spark, sf_dir), kinds=("section", "abstract", "table_md")).select("doc_id", "kind", "ord", "content")


@query(
    rf"""{_LINES} SELECT doc_id, i::INT AS ord, '## S' || (i - 1) || chr(10) || chr(10) || para || chr(10) || chr(10) || '### Inner' || chr(10) || chr(10) || 'in [1,2]' AS content FROM p"""
)
def document_sections_nested(spark, sf_dir):
    return documents.parse_documents(_nested_xml(spark, sf_dir), nested=True, kinds=("section",)).select("doc_id", "ord", "content")


@query(
    rf"""{_LINES}, t AS (SELECT doc_id, string_agg('## S' || (i - 1) || chr(10) || chr(10) || replace(para, '[2,7]', '[2] , [?]') || chr(10) || chr(10) || '### Table ' || i || chr(10) || '**Caption:** C' || (i - 1) || chr(10) || chr(10) || md
      || chr(10) || chr(10) || '## Inner' || chr(10) || chr(10) || 'in [1,2]', chr(10) || chr(10) ORDER BY i) AS s FROM p GROUP BY 1)
    SELECT doc_id, '# D' || chr(10) || chr(10) || '# Abstract' || chr(10) || chr(10) || 'A ' || doc_id || chr(10) || chr(10) || 'B' || chr(10) || chr(10) || s AS paper FROM t"""
)
def papers_with_unknown_references(spark, sf_dir):
    return documents.parse_documents(_nested_xml(spark, sf_dir), unknown="?", kinds=("paper",)).select("doc_id", F.col("content").alias("paper"))


@query(rf"SELECT doc_id, '# D' || chr(10) || chr(10) || trim(regexp_replace(x, '{_WS}+', ' ', 'g')) AS paper, 1::BIGINT AS sections FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0b\x0c\x0e-\x1f\[\]()]', ' ', 'g') AS x FROM documents) WHERE trim(regexp_replace(x, '{_WS}+', ' ', 'g')) <> ''")
def documents_without_sections(spark, sf_dir):
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(F.lit("<doc><dc:title>D</dc:title><ce:para>"), esc(F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\[\]()]", " ")), F.lit("</ce:para></doc>"))
    d = documents.parse_documents(table(spark, sf_dir, "documents").select("doc_id", xml.alias("xml")), nested=True, kinds=("paper", "section"))
    return d.groupBy("doc_id").agg(F.max(F.when(F.col("kind") == "paper", F.col("content"))).alias("paper"), F.count_if(F.col("kind") == "section").alias("sections")).filter("sections > 0")


@query("SELECT doc_id, '2' AS label, 'R' AS title, '10.1/r' AS doi FROM documents WHERE text IS NOT NULL")
def document_reference_rows(spark, sf_dir):
    return documents.references(documents.parse_documents(_nested_xml(spark, sf_dir), kinds=("reference",))).select("doc_id", "label", "title", "doi")


@query("SELECT doc_id, replace(translate(text, '[]()', '    '), '.', ' [3,4] [5,6].') AS c FROM documents")
def citations_in_texts(spark, sf_dir):
    raw = F.replace(F.translate("text", "[]()", "    "), F.lit("."), F.lit(" ([3]; [4]) [5], [6]."))
    return table(spark, sf_dir, "documents").select("doc_id", text.compress_citations(raw).alias("c"))


@query(rf"""{q_normalize._SIGNALS}, y AS (SELECT doc_id, unnest(list_filter([CASE WHEN NOT evidence THEN 1 END, CASE WHEN lower(symbol) IN ('tau0', 'n', 'h0') AND value IS NULL THEN 2 END,
      CASE WHEN origin_type = 'adopted' AND (n_calibration > 0 OR this_study) THEN 3 END, CASE WHEN origin_type = 'calibrated' AND n_adopted > 0 THEN 4 END], lambda r: r IS NOT NULL)) AS t FROM x)
    SELECT (SELECT count(*) FROM x) AS total, count(*) AS issues, count(*) FILTER (t = 1) AS missing_evidence, count(*) FILTER (t = 2) AS missing_key_parameter_value, count(*) FILTER (t = 3) AS source_conflict_origin_vs_calibration,
      count(*) FILTER (t = 4) AS source_conflict_origin_vs_adopted FROM y""")  # fmt: skip
def quality_counters(spark, sf_dir):
    rows = q_normalize._signals(spark, sf_dir)
    return normalize.quality_counts(normalize.quality_issues(rows, ["doc_id"]), rows)


@query(
    """WITH x AS (SELECT event_id, '{"material":{"name":"' || event_type || '"},"model":{"class":"c' || (event_id % 7) || '"},"notes":"' || event_id || '"}' AS doc, event_type, event_id % 7 AS c FROM events)
    SELECT event_id, CASE WHEN event_type ILIKE '%c%' THEN '$.material.name' WHEN true THEN '$.model.class' END AS path FROM x ORDER BY event_id LIMIT 500"""
)
def json_path_search(spark, sf_dir):
    doc = F.to_json(F.struct(F.struct(F.col("event_type").alias("name")).alias("material"), F.struct(F.concat(F.lit("c"), (F.col("event_id") % 7).cast("string")).alias("class")).alias("model"), F.col("event_id").cast("string").alias("notes")))
    d = table(spark, sf_dir, "events").select("event_id", doc.alias("doc"))
    return retrieval.json_search(d, "doc", "c", ["$.material.name", "$.model.class", "$.notes"], ["event_id"], 500).select("event_id", "path")


@query("SELECT event_id, event_type, value, props FROM events")
def json_written_and_read(spark, sf_dir):
    path = scratch(spark, "json") + "/rows.jsonl"
    sinks.write_json_objects(table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props"), path)
    return readers.json_records(spark, path, "event_id bigint, event_type string, value double, props string")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def csv_written_and_read(spark, sf_dir):
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "customer"), path, ["c_custkey", "c_name", "c_mktsegment"])
    return readers.csv_texts(spark, path)


@query("SELECT c_name AS doi, CASE WHEN c_custkey % 2 = 0 THEN 'ok' ELSE 'failed' END AS status, true AS stamped FROM customer UNION ALL SELECT s_name, 'ok', true FROM supplier")
def status_log(spark, sf_dir):
    path = scratch(spark, "status") + "/log.jsonl"
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("doi"), F.when(F.col("c_custkey") % 2 == 0, "ok").otherwise("failed").alias("status"))
    sinks.append_status(c, path)
    sinks.append_status(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("doi"), F.lit("ok").alias("status")), path)
    return readers.json_records(spark, path, "doi string, status string, timestamp_utc string").select("doi", "status", F.col("timestamp_utc").isNotNull().alias("stamped"))


@query("SELECT page_id, url, html FROM pages")
def raw_pages(spark, sf_dir):
    path = scratch(spark, "raw")
    sinks.write_raw_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return spark.read.parquet(path)


@query("SELECT string_agg(r_name, chr(10) ORDER BY r_name) || chr(10) AS text, (sum(length(r_name)) + count(*))::INT AS length FROM region")
def folder_texts(spark, sf_dir):
    path = scratch(spark, "texts")
    table(spark, sf_dir, "region").select("r_name").coalesce(1).sortWithinPartitions("r_name").write.text(path)
    return readers.folder_files(spark, path, "*.txt").select("text", "length")


#: Three levels, with lists of objects in objects of a list.
_DEEP = '{"id": "", "parameters": {"registry": [{"name": "", "refs": [""], "at": {"pages": [{"n": 0}]}}], "notes": ""}}'
_SQL_LINES = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::BIGINT AS q FROM lineitem"


def _deep_records(spark, sf_dir):
    """One record an order, an item a line: some items are no objects, some lists no lists, some keys unknown, some orders' registry is a number."""
    item = F.expr(
        """CASE WHEN l_partkey % 11 = 0 THEN '7' WHEN l_partkey % 7 = 0 THEN concat('{"name":', l_partkey, ',"refs":"no"}')
        WHEN l_partkey % 5 = 0 THEN concat('{"name":"p', l_partkey, '","refs":["', l_suppkey, '"],"at":{"pages":[{"n":', l_linenumber, '},3]},"seen":', cast(l_quantity AS bigint), '}')
        ELSE concat('{"refs":[],"at":{"pages":[]},"name":"p', l_partkey, '"}') END"""
    )
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", item.alias("x")))), lambda r: r["x"]), ",").alias("items"))
    doc = F.when(F.col("l_orderkey") % 9 == 0, '{"parameters":{"registry":7,"run":1}}').when(F.col("l_orderkey") % 10 == 0, "[]").otherwise(F.concat(F.lit('{"id":"'), F.col("l_orderkey").cast("string"), F.lit('","parameters":{"registry":['), "items", F.lit(']},"run":{"by":"x"}}')))
    return rows.select(F.col("l_orderkey").alias("record_id"), doc.alias("doc"))


@query(
    f"""WITH l AS ({_SQL_LINES}), o AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 = 0) AS refs, sum(CASE WHEN l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 = 0 THEN q END) AS seen FROM l GROUP BY 1),
    k AS (SELECT *, CASE WHEN l_orderkey % 9 = 0 THEN 'n' WHEN l_orderkey % 10 = 0 THEN 'e' ELSE 'r' END AS kind FROM o)
    SELECT l_orderkey AS record_id, CASE WHEN kind = 'r' THEN l_orderkey::VARCHAR END AS id, (CASE WHEN kind = 'r' THEN n ELSE 0 END)::INT AS n_items, (CASE WHEN kind = 'r' THEN refs ELSE 0 END)::BIGINT AS n_refs,
      (CASE WHEN kind = 'r' THEN 2 * refs ELSE 0 END)::BIGINT AS n_pages, (CASE WHEN kind = 'r' THEN coalesce(seen, 0) ELSE 0 END)::BIGINT AS seen, CASE WHEN kind = 'n' THEN '1' END AS kept_inside, CASE WHEN kind = 'r' THEN 'x' END AS kept_outside FROM k"""
)
def records_in_shape(spark, sf_dir):
    """Records of lists of objects take the template's shape; counts of what it holds and of the keys it does not know."""
    r = _deep_records(spark, sf_dir).select("record_id", nested.coerced(F.try_parse_json("doc"), nested.skeleton(_DEEP)).alias("r"))
    items = F.variant_get("r", "$.parameters.registry", "array<variant>")
    count = lambda path: F.aggregate(F.transform("items", lambda x: F.size(F.variant_get(x, path, "array<variant>")).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    seen = F.aggregate(F.transform("items", lambda x: F.coalesce(F.try_variant_get(x, "$.seen", "long"), F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s + x)
    got = lambda path: F.try_variant_get("r", path, "string")
    r = r.withColumn("items", items)
    return r.select("record_id", got("$.id").alias("id"), F.size("items").alias("n_items"), count("$.refs").alias("n_refs"), count("$.at.pages").alias("n_pages"), seen.alias("seen"), got("$.parameters.run").alias("kept_inside"), got("$.run.by").alias("kept_outside"))


@query(
    f"""WITH l AS ({_SQL_LINES}), i AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos FROM l WHERE l_orderkey % 9 <> 0 AND l_orderkey % 10 <> 0),
    f AS (
      SELECT l_orderkey, 'parameters.registry[' || pos || '] must be an object' AS fault FROM i WHERE l_partkey % 11 = 0
      UNION ALL SELECT l_orderkey, 'parameters.registry[' || pos || '].refs must be a list' FROM i WHERE l_partkey % 11 <> 0 AND l_partkey % 7 = 0
      UNION ALL SELECT l_orderkey, 'parameters.registry[' || pos || '].at must be an object' FROM i WHERE l_partkey % 11 <> 0 AND l_partkey % 7 = 0
      UNION ALL SELECT l_orderkey, 'parameters.registry[' || pos || '].at.pages[1] must be an object' FROM i WHERE l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 = 0
      UNION ALL SELECT DISTINCT l_orderkey, unnest(['missing top-level key: id', 'parameters.registry must be a list']) FROM l WHERE l_orderkey % 9 = 0
      UNION ALL SELECT DISTINCT l_orderkey, 'payload is not an object' FROM l WHERE l_orderkey % 9 <> 0 AND l_orderkey % 10 = 0)
    SELECT l_orderkey AS record_id, fault FROM f"""
)
def record_faults(spark, sf_dir):
    """Every place of nested records that departs from the template, with its path."""
    return nested.faults(_deep_records(spark, sf_dir), nested.skeleton(_DEEP)).select("record_id", "fault")


@query(
    f"""WITH l AS ({_SQL_LINES}), i AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS pos FROM l WHERE l_orderkey % 9 <> 0 AND l_orderkey % 10 <> 0), s AS (SELECT *, 'parameters.registry[' || pos || ']' AS p FROM i)
    SELECT l_orderkey AS record_id, p AS path, '7' AS value FROM s WHERE l_partkey % 11 = 0
    UNION ALL SELECT l_orderkey, p || '.name', CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'p' END || l_partkey FROM s WHERE l_partkey % 11 <> 0
    UNION ALL SELECT l_orderkey, p || '.refs', 'no' FROM s WHERE l_partkey % 11 <> 0 AND l_partkey % 7 = 0
    UNION ALL SELECT l_orderkey, p || unnest(['.refs[0]', '.at.pages[0].n', '.at.pages[1]', '.seen']), unnest([l_suppkey::VARCHAR, l_linenumber::VARCHAR, '3', q::VARCHAR]) FROM s WHERE l_partkey % 11 <> 0 AND l_partkey % 7 <> 0 AND l_partkey % 5 = 0
    UNION ALL SELECT DISTINCT l_orderkey, unnest(['id', 'run.by']), unnest([l_orderkey::VARCHAR, 'x']) FROM i
    UNION ALL SELECT DISTINCT l_orderkey, unnest(['parameters.registry', 'parameters.run']), unnest(['7', '1']) FROM l WHERE l_orderkey % 9 = 0"""
)
def nested_leaves(spark, sf_dir):
    """Leaves of nested records with their paths."""
    return nested.flatten(_deep_records(spark, sf_dir))


def _served(folder: str, size: int):
    """Stands in for a paged HTTP search: answers from files of ``size`` entries each, as a server would from its table."""

    def fetch(options: dict, start: int, count: int) -> str:
        got = []
        for k in range(start // size, (start + count - 1) // size + 1):
            try:
                with open(f"{folder}/{k}.json", encoding="utf-8") as f:
                    got += json.load(f)[max(0, start - k * size) : start + count - k * size]
            except FileNotFoundError:
                break
        return json.dumps({"search-results": {"entry": got}})

    return fetch


@query("SELECT '10.1/' || p_partkey AS doi, p_name AS title, p_brand AS journal, 1900 + p_size AS year FROM part")
def paged_search_stream(spark, sf_dir):
    """All pages of a search as a stream, in two runs on one checkpoint: the second goes on where the first ended."""
    shared = scratch(spark, "served").removeprefix("file://")
    size, folder = 100, Path(shared if shared.startswith("/") else tempfile.mkdtemp(prefix="lodestrata-pages-"))  # a store that is no folder leaves a local one
    atexit.register(shutil.rmtree, folder, True)
    c, served = F.col, str(folder)
    doc = F.struct(F.concat(F.lit("10.1/"), c("p_partkey").cast("string")).alias("prism:doi"), c("p_name").alias("dc:title"), c("p_brand").alias("prism:publicationName"), F.concat((c("p_size") + 1900).cast("string"), F.lit("-05-01")).alias("prism:coverDate"))
    entries = numbered(table(spark, sf_dir, "part").select("p_partkey", F.to_json(doc).alias("entry")), ["p_partkey"], "nth").withColumn("page", F.floor((F.col("nth") - 1) / size))
    pages = entries.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("nth", "entry"))).alias("x")).select("page", F.concat(F.lit("["), F.array_join(F.col("x.entry"), ","), F.lit("]")).alias("text"))

    def write(rows):  # the stub server's files: the tasks write them, no row comes to the driver
        Path(served).mkdir(parents=True, exist_ok=True)
        for r in rows:
            Path(served, f"{r.page}.json").write_text(r.text, encoding="utf-8")

    pages.foreachPartition(write)
    name, out = f"papers_{folder.name[-8:].lower()}", scratch(spark, "pages")
    spark.dataSource.register(rest.make_paged_source(name, _served(str(folder), size), lambda d: d["search-results"]["entry"]))
    for most in (3, 1_000_000):
        stream = spark.readStream.format(name).option("count", 100).option("maxPages", most).option("pagesPerBatch", 1_000_000).option("pauseSeconds", 0).load()
        stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return rest.search_entries(spark.read.parquet(f"{out}/rows")).select("doi", "title", "journal", "year")


def _folders(spark, sf_dir, files) -> str:
    """A local corpus as the readers meet it: a folder for each supplier, with the files (name, text) that ``files`` gives of a row."""
    root = Path(tempfile.mkdtemp(prefix="lodestrata-corpus-"))
    atexit.register(shutil.rmtree, root, True)
    for r in table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey").toLocalIterator():
        for name, content in files(r):
            path = root / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(content, encoding="utf-8")
    return str(root)


@query(
    """WITH s AS (SELECT s_suppkey, s_suppkey // 2 AS h FROM supplier),
    f AS (SELECT CASE WHEN s_suppkey % 5 = 4 THEN NULL WHEN s_suppkey % 2 = 0 THEN '10.1016/J.X' || h ELSE '10.1016/j.x' || h END AS doi, 'f' || lpad(s_suppkey::VARCHAR, 6, '0') AS folder FROM s)
    SELECT lower(doi) AS doi, min(folder) AS folder FROM f WHERE doi IS NOT NULL GROUP BY 1"""
)
def local_papers(spark, sf_dir):
    """Folders with a paper, by the DOI in its text; of two that differ in case only the first folder counts, and folders without one are none."""

    def files(r):
        doi = f"10.1016/{'J.X' if r.s_suppkey % 2 == 0 else 'j.x'}{r.s_suppkey // 2}"
        yield f"f{r.s_suppkey:06d}/paper.xml", "<d>none</d>" if r.s_suppkey % 5 == 4 else f"<d><prism:doi>{doi}</prism:doi></d>"

    d = readers.local_corpus(spark, _folders(spark, sf_dir, files))
    return d.select(F.lower("doi").alias("doi"), F.regexp_extract("folder", r"([^/]+)$", 1).alias("folder"))


@query("SELECT 'p' || s_suppkey AS folder, s_nationkey::BIGINT AS n FROM supplier WHERE s_suppkey % 4 <> 0")
def prediction_folders(spark, sf_dir):
    """One JSON file a folder; those that cannot be read are passed over."""
    root = _folders(spark, sf_dir, lambda r: [(f"p{r.s_suppkey}/record.json", "{broken" if r.s_suppkey % 4 == 0 else json.dumps({"n": r.s_nationkey})), (f"p{r.s_suppkey}/other.json", "{}")])
    return readers.record_folders(spark, root).select("folder", F.get_json_object("doc", "$.n").cast("long").alias("n"))


@query(
    f"""SELECT s_suppkey AS doc_id, kind, name, content FROM supplier, (SELECT unnest(['title', 'section', 'paper']) AS kind, unnest(['title', '001_S.md', 'paper.md']) AS name, unnest([1, 2, 3]) AS k),
      LATERAL (SELECT [s_name, '## S' || chr(10) || chr(10) || 'x ' || s_nationkey, '# ' || s_name || chr(10) || chr(10) || '## S' || chr(10) || chr(10) || 'x ' || s_nationkey][k] AS content)"""
)
def documents_written_by_kind(spark, sf_dir):
    """Parsed documents written by kind, and read again."""
    xml = F.concat(F.lit("<d><dc:title>"), "s_name", F.lit("</dc:title><sec><title>S</title><p>x "), F.col("s_nationkey").cast("string"), F.lit("</p></sec></d>"))
    path = scratch(spark, "documents")
    sinks.write_documents(documents.parse_documents(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"), xml.alias("xml"))), path)
    return spark.read.parquet(path).select("doc_id", "kind", "name", "content")


@query("SELECT s_suppkey AS doc_id, '=== SECTION: 001_Constitutive model.md (score=2) ===' AS head FROM supplier WHERE s_suppkey % 3 <> 0")
def contexts_of_documents(spark, sf_dir):
    """Contexts for a model; a document without a relevant part has none, and no call is made for it."""
    title = F.when(F.col("s_suppkey") % 3 == 0, "Thanks").otherwise("Constitutive model")
    xml = F.concat(F.lit("<d><dc:title>T</dc:title><sec><title>"), title, F.lit("</title><p>x</p></sec></d>"))
    got = lifecycle.contexts(documents.parse_documents(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"), xml.alias("xml")), kinds=("section", "abstract", "table_md")))
    return got.select("doc_id", F.regexp_extract("context", "=== [^\n]*", 0).alias("head"))
