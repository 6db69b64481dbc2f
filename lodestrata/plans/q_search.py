"""Queries of retrieval, search, ranking and selection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.operators import context, infix, retrieval, review, search
from lodestrata.plans.registry import ORACLES, query
from lodestrata.session import table

KEYWORDS = ["the", "tion", "schein", "que", "the", ""]
ALLOWED = ["en", "de"]
RELEVANT = [*context.SECTION_WORDS, "ación ", "ung "]


@query(
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT v FROM q)), 6) AS score
    FROM embeddings WHERE embedding IS NOT NULL ORDER BY score DESC, vec_id LIMIT 10
    """
)
def vector_topk(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return retrieval.vector_topk(emb, emb.filter(F.col("vec_id") == 0).select(F.col("embedding").alias("query_vec")), k=10).select("vec_id", "label", "score")


@query("SELECT doc_id, source, left(text, 280) AS snippet FROM documents WHERE text ILIKE '%token = %' ORDER BY doc_id LIMIT 10")
def keyword_search(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return retrieval.keyword_search(d, "text", "token = ", "doc_id", 10).select("doc_id", "source", retrieval.snippet(F.col("text")).alias("snippet"))


@query(
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
    c AS (SELECT vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT v FROM q)), 6) AS score, NULL AS snippet, 'chunk_hits' AS hit_list
          FROM embeddings WHERE embedding IS NOT NULL ORDER BY score DESC, vec_id LIMIT 10),
    p AS (SELECT doc_id AS id, NULL AS score, left(text, 100) AS snippet, 'parameter_hits' AS hit_list FROM documents WHERE text ILIKE '%license%' ORDER BY doc_id LIMIT 10)
    SELECT id, score::DOUBLE AS score, snippet::VARCHAR AS snippet, hit_list FROM c UNION ALL SELECT id, score, snippet, hit_list FROM p
    """
)
def hybrid_retrieve(spark, sf_dir):
    emb, docs = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    a = retrieval.vector_topk(emb, emb.filter("vec_id = 0").select(F.col("embedding").alias("query_vec")), k=10).select(F.col("vec_id").alias("id"), "score")
    b = retrieval.keyword_search(docs, "text", "license", "doc_id", 10).select(F.col("doc_id").alias("id"), F.left("text", F.lit(100)).alias("snippet"))
    return retrieval.hybrid(a, b).select("id", "score", "snippet", "hit_list")


@query(
    """
    SELECT 'Question: which?' || chr(10) || chr(10) || 'Evidence:' || chr(10) || string_agg('[E' || rn || '] ' || t, chr(10) ORDER BY rn) AS prompt
    FROM (SELECT row_number() OVER (ORDER BY doc_id) AS rn, left(text, 900) AS t FROM (SELECT * FROM documents WHERE text ILIKE '%license%' ORDER BY doc_id LIMIT 8))
    """
)
def evidence_prompt(spark, sf_dir):
    hits = retrieval.keyword_search(table(spark, sf_dir, "documents"), "text", "license", "doc_id", 8).withColumn("snippet", retrieval.snippet(F.col("text"), 900))
    return retrieval.evidence_prompt(hits, "which?", ["doc_id"], "snippet")


def _score_sql(text: str) -> str:
    return " + ".join(f"(contains(lower({text}), '{k}'))::INT" for k in KEYWORDS if k)


@query(f"SELECT doc_id, source, {_score_sql('text')} AS score FROM documents ORDER BY score DESC, doc_id LIMIT 50")
def keyword_score_rank(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("score", search.keyword_score(F.col("text"), KEYWORDS))
    return search.rank(d, "score", ["doc_id"]).select("doc_id", "source", "score").limit(50)


@query(f"SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM (SELECT doc_id, source, {_score_sql('text')} AS score FROM documents)")
def keyword_score_rank_all(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", search.keyword_score(F.col("text"), KEYWORDS).alias("score"))
    return search.ranked(d, "score", ["doc_id"])


_REASON = "CASE WHEN coalesce(source, '') = '' THEN 'no_doi' WHEN coalesce(lang, '') <> '' AND lang NOT IN ('en', 'de') THEN 'doctype' WHEN n_chars < 200 THEN 'year' WHEN n_chars > 8000 THEN 'year' END"


def _reasons(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.withColumn("reason", search.drop_reason(F.col("source"), F.col("lang"), F.col("n_chars"), ALLOWED, 200, 8000))


@query(f"SELECT coalesce(r, 'kept') AS reason, count(*) AS n FROM (SELECT {_REASON} AS r FROM documents) GROUP BY ALL")
def funnel_counts(spark, sf_dir):
    return search.reason_counts(_reasons(spark, sf_dir))


@query(f"SELECT doc_id, lang, source, n_chars FROM documents WHERE ({_REASON}) IS NULL")
def funnel_filter(spark, sf_dir):
    return _reasons(spark, sf_dir).filter("reason IS NULL").select("doc_id", "lang", "source", "n_chars")


@query(
    f"""
    SELECT count(*) AS raw, count(DISTINCT text) AS dedup, count(*) FILTER (r IS NULL) AS kept, count(*) FILTER (r = 'no_doi') AS dropped_no_doi,
           count(*) FILTER (r = 'doctype') AS dropped_doctype, count(*) FILTER (r = 'year') AS dropped_year FROM (SELECT text, {_REASON} AS r FROM documents)
    """
)
def search_report(spark, sf_dir):
    return search.search_report(_reasons(spark, sf_dir), "text")


@query(
    f"""
    SELECT doc_id, score, position FROM (
      SELECT doc_id, {_score_sql('text')} + doc_id % 3 AS score, min(doc_id) OVER (PARTITION BY text) AS position,
             row_number() OVER (PARTITION BY text ORDER BY {_score_sql('text')} + doc_id % 3 DESC, doc_id) AS rn FROM documents) WHERE rn = 1
    """
)
def dedup_keep_best(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("score", search.keyword_score(F.col("text"), KEYWORDS) + F.col("doc_id") % 3)
    return search.keep_best(d.select("doc_id", "score", F.md5("text").alias("h")), ["h"], "score", ["doc_id"]).select("doc_id", "score", "position")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedup_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", F.md5(F.lower("text")).alias("h"))
    return search.keep_first(d, F.col("h"), ["doc_id"]).select("doc_id", "lang")


@query("SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (PARTITION BY lower(regexp_replace(url, '[?#].*$', '')) ORDER BY page_id) AS rn FROM pages) WHERE rn = 1")
def dedup_pages(spark, sf_dir):
    return search.keep_first(table(spark, sf_dir, "pages").select("page_id", "url"), F.lower(F.regexp_replace("url", r"[?#].*$", "")), ["page_id"]).select("page_id", "url")


#: What one context is made of: a run of 400 ids of a source.
_PAPER = "source || '/' || doc_id // 400"
_PART = "chr(10) || chr(10) || '=== SECTION: ' || 'doc_' || doc_id || ' ===' || chr(10) || left(text, 3500)"


def _parts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    return d.select("doc_id", "source", F.concat_ws("/", "source", F.expr("doc_id div 400")).alias("paper"), "lang", name.alias("name"), context.part("SECTION", name, F.left("text", F.lit(3500))).alias("part")).withColumn("len", F.length("part").cast("bigint"))


@query(
    f"""
    SELECT doc_id, source, before::BIGINT AS before FROM (
      SELECT doc_id, source, coalesce(sum(len) OVER (PARTITION BY paper ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT doc_id, source, {_PAPER} AS paper, length({_PART}) AS len FROM documents)) WHERE before <= 24000
    """
)
def context_budget_inclusive(spark, sf_dir):
    return context.budget_inclusive(_parts(spark, sf_dir), "paper", ["doc_id"], "len", 24000).select("doc_id", "source", "before")


@query(
    f"""
    SELECT doc_id, source, total::BIGINT AS total FROM (
      SELECT doc_id, source, sum(len) OVER (PARTITION BY paper ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS total
      FROM (SELECT doc_id, source, {_PAPER} AS paper, length({_PART}) AS len FROM documents)) WHERE total <= 24000
    """
)
def context_budget_strict(spark, sf_dir):
    return context.budget_strict(_parts(spark, sf_dir), "paper", ["doc_id"], "len", 24000).select("doc_id", "source", "total")


_KIND = "CASE WHEN doc_id % 3 = 0 THEN 'table' ELSE 'section' END"


@query(
    f"""
    WITH p AS (SELECT doc_id, source, {_PAPER} AS paper, {_KIND} AS kind, length({_PART}) AS len FROM documents),
    s AS (SELECT * FROM (SELECT *, sum(len) OVER (PARTITION BY paper ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS total FROM p WHERE kind = 'section') WHERE total <= 24000),
    u AS (SELECT paper, max(total) AS used FROM s GROUP BY paper),
    t AS (SELECT * FROM (SELECT p.*, coalesce(used, 0) + sum(len) OVER (PARTITION BY p.paper ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS total FROM p LEFT JOIN u ON p.paper = u.paper WHERE kind = 'table') WHERE total <= 24000)
    SELECT doc_id, source, kind, total::BIGINT AS total FROM s UNION ALL SELECT doc_id, source, kind, total::BIGINT FROM t
    """
)
def context_budget_shared(spark, sf_dir):
    p = _parts(spark, sf_dir).withColumn("kind", F.expr(_KIND))
    return context.budget_sections_then_tables(p, "paper", "kind", ["doc_id"], "len", 24000).select("doc_id", "source", "kind", "total")


@query(
    f"""
    SELECT doc_id, source, kind FROM (
      SELECT *, coalesce(sum(len) OVER (PARTITION BY paper ORDER BY kind, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             row_number() OVER (PARTITION BY paper, kind ORDER BY doc_id) AS rn FROM (SELECT doc_id, source, {_PAPER} AS paper, {_KIND} AS kind, length({_PART}) AS len FROM documents))
    WHERE before <= 24000 OR kind = 'table' AND rn = 1
    """
)
def context_budget_first_table(spark, sf_dir):
    p = _parts(spark, sf_dir).withColumn("kind", F.expr(_KIND))
    return context.budget_first_table(p, "paper", "kind", ["doc_id"], "len", 24000).select("doc_id", "source", "kind")


@query(
    """
    WITH d AS (SELECT d.doc_id, d.source, d.lang, coalesce(l.toxic = 1, false) AS sel FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id))
    SELECT doc_id, source, lang, sel FROM (
      SELECT *, bool_or(sel) OVER (PARTITION BY source, lang) AS anysel, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM d) WHERE sel OR NOT anysel AND rn <= 2
    """
)
def selection_fallback(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    d = table(spark, sf_dir, "documents").join(lab, "doc_id", "left").select("doc_id", "source", "lang", F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("sel"))
    return context.selected_or_first(d, ["source", "lang"], ["doc_id"], "sel", 2)


@query(
    f"""
    SELECT doc_id, s AS score FROM (SELECT doc_id, {' + '.join(f"(contains(lower(trim(regexp_replace(text, '[ \t\n\r]+', ' ', 'g'))), '{k}'))::INT" for k in RELEVANT)} AS s FROM documents) WHERE s > 0
    """
)
def relevant_sections(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", search.keyword_score_squeezed(F.col("text"), RELEVANT).alias("score"), F.lit("body.md").alias("name"))
    return d.filter(context.relevant_section(F.col("score"), F.col("name"))).select("doc_id", "score")


@query(
    """
    SELECT source || '/' || doc_id // 400 AS paper, string_agg('- doc_' || doc_id || ' | len=' || length(text) || ' | snippet="' || replace(left(text, 300), chr(10), ' ') || '"', chr(10) ORDER BY doc_id) AS catalog
    FROM documents GROUP BY 1
    """
)
def trim_catalog(spark, sf_dir):
    return context.catalog(_parts(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), "paper", "name", "text", ["doc_id"])


@query(
    """
    SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, min(p_partkey) LIMIT 20
    """
)
def top_materials(spark, sf_dir):
    return review.most_common(table(spark, sf_dir, "part"), "p_type", ["p_partkey"], 20)


@query("SELECT coalesce(nullif(trim(lang), ''), nullif(trim(source), ''), 'unknown') AS bucket, count(*) AS n FROM documents GROUP BY 1")
def source_distribution(spark, sf_dir):
    return review.distribution(table(spark, sf_dir, "documents"), "lang", "source")


@query(
    """
    SELECT doc_id, source, pick_round::INT AS pick_round FROM (
      SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS pick_round, count(*) OVER (PARTITION BY source) AS sz,
             first_value(md5(doc_id::VARCHAR)) OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS f FROM documents)
    ORDER BY pick_round, sz DESC, f LIMIT 50
    """
)
def stratified_round_robin(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("k", F.md5(F.col("doc_id").cast("string")))
    return review.round_robin(d, "source", ["k", "doc_id"], 50).select("doc_id", "source", "pick_round")


@query(
    """
    SELECT '# Sources' || chr(10) || chr(10) || string_agg('- ' || source || ': ' || n, chr(10) ORDER BY n DESC, source) AS report FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)
    """
)
def markdown_report(spark, sf_dir):
    return review.markdown_summary(table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")), "source", "n", "Sources")


_PATTERN = r"""CASE WHEN item_id % 6 = 0 THEN substr(text, 3, 2) WHEN item_id % 6 = 1 THEN substr(text, 2, 4) || '%' || substr(text, 30, 5) WHEN item_id % 6 = 2 THEN substr(text, 5, 3) || '_' || substr(text, 9, 3)
    WHEN item_id % 6 = 3 THEN upper(substr(text, 1, 12)) WHEN item_id % 6 = 4 THEN substr(text, 1, 1) || '%' ELSE text END"""


@query(f"SELECT item_id AS query_id, doc_id FROM documents JOIN (SELECT item_id, {_PATTERN} AS pattern FROM benchmark) ON text ILIKE '%' || pattern || '%'")
def infix_search(spark, sf_dir):
    """Which documents hold each pattern: parts of the benchmark texts, short ones and ones with wildcards among them."""
    index = infix.build(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return infix.matches(index, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.expr(_PATTERN).alias("pattern"))).withColumnRenamed("id", "doc_id")


_FOUND = """
    WITH x AS (SELECT p_partkey AS doi, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS material, p_type AS framework, CASE WHEN p_partkey % 4 > 0 THEN 'r' || p_size END AS flow_rule, p_name FROM part)
    SELECT doi, material, framework, flow_rule FROM x WHERE (p_name || coalesce(material, '') || framework) ILIKE '%br%' ORDER BY doi LIMIT 50
"""


def _part_records(spark, sf_dir):
    c, k = F.col, F.col("p_partkey")
    doc = F.to_json(F.struct(c("p_name").alias("title"), F.struct(F.when(k % 3 == 0, c("p_brand")).alias("name")).alias("material"), F.struct(c("p_type").alias("framework")).alias("constitutive_model"), F.struct(F.when(k % 4 > 0, F.concat(F.lit("r"), c("p_size").cast("string"))).alias("flow_rule")).alias("plastic_parameters")))
    return table(spark, sf_dir, "part").select(k.alias("doi"), doc.alias("doc"))


@query(_FOUND)
def parameter_hits(spark, sf_dir):
    """Records whose whole text holds the query, with the three fields that a hit shows."""
    return retrieval.parameter_search(_part_records(spark, sf_dir), "doc", "br", retrieval.PARAMETER_FIELDS, "doi", 50)


@query(f"""SELECT 'parameter_hits' AS hit_list, doi, material, framework, flow_rule, NULL::DOUBLE AS score FROM ({_FOUND})
    UNION ALL SELECT * FROM (SELECT 'chunk_hits', vec_id, NULL, NULL, NULL, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS s FROM embeddings ORDER BY s DESC, vec_id LIMIT 10)""")  # fmt: skip
def hybrid_with_fields(spark, sf_dir):
    """Both lists of a hybrid search: nearest chunks, and records with their three fields."""
    emb = table(spark, sf_dir, "embeddings")
    near = retrieval.vector_topk(emb, emb.filter("vec_id = 0").select(F.col("embedding").alias("query_vec")), 10).select(F.col("vec_id").alias("doi"), "score")
    return retrieval.hybrid(near, parameter_hits(spark, sf_dir)).select("hit_list", "doi", "material", "framework", "flow_rule", "score")


@query(f"SELECT row_number() OVER (ORDER BY doc_id)::BIGINT AS place, doc_id, source FROM ({ORACLES['stratified_round_robin']})")
def pilot_labels(spark, sf_dir):
    """The picked rows in the order of their keys, with the place that each then has."""
    d = table(spark, sf_dir, "documents").withColumn("k", F.md5(F.col("doc_id").cast("string")))
    picked = review.pilot(d, "source", ["k", "doc_id"], 50, "doc_id").select("doc_id", "source")
    return picked.select(F.monotonically_increasing_id().alias("at"), "*").select(F.row_number().over(Window.orderBy("at")).cast("long").alias("place"), "doc_id", "source")  # 50 rows
