"""Queries of text, chunks, JSON, dates and markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.functions import nested, numeric, text
from lodestrata.operators import chunks, documents, models
from lodestrata.plans.registry import ORACLES, query
from lodestrata.session import table
from lodestrata.storage import scratch

_WS = r"[ \t\n\x0b\x0c\r]"


@query(rf"SELECT doc_id, lower(trim(regexp_replace(text, '{_WS}+', ' ', 'g'))) AS norm FROM documents")
def norm_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.norm_text(F.col("text")).alias("norm"))


@query(
    rf"""
    WITH d AS (SELECT doc_id, regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') AS t FROM documents),
    c AS (SELECT doc_id, p, regexp_replace(substr(t, p + 1, 1200), '^{_WS}+|{_WS}+$', '', 'g') AS chunk FROM (SELECT doc_id, t, unnest(range(0, length(t), 1000)) AS p FROM d))
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1)::INT AS chunk_index, chunk FROM c WHERE chunk <> ''
    """
)
def chunk_documents(spark, sf_dir):
    return chunks.chunk_text(table(spark, sf_dir, "documents")).withColumn("chunk_index", F.col("chunk_index").cast("int"))


@query(rf"SELECT doc_id, CASE WHEN length(t) > 500 THEN left(t, 500) || '...[TRUNCATED]...' ELSE t END AS t FROM (SELECT doc_id, regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g') AS t FROM documents)")
def trim_long_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.trim_text(F.col("text"), 500).alias("t"))


@query(
    r"""
    SELECT p_partkey, regexp_replace(p_name, '[^a-zA-Z0-9._-]+', '_', 'g') AS safe,
           regexp_replace(regexp_replace(regexp_replace(lower(trim(p_type)), '[ -]', '_', 'g'), '_{2,}', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
           left(regexp_replace(regexp_replace(trim(p_name), '\s+', ' ', 'g'), '[^\w\-_ .]', '_', 'g'), 80) AS filename FROM part
    """
)
def safe_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_id(F.col("p_name")).alias("safe"), text.slug(F.col("p_type")).alias("slug"), text.safe_filename(F.col("p_name")).alias("filename"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k_num, json_extract_string(props, '$.missing') AS missing FROM events")
def json_extract_typed(spark, sf_dir):
    p = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", nested.typed_path(p, "$.k", "bigint").alias("k"), numeric.to_float(F.get_json_object(p, "$.k")).alias("k_num"), F.get_json_object(p, "$.missing").alias("missing"))


@query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS value FROM events WHERE props IS NOT NULL")
def json_flatten(spark, sf_dir):
    return nested.flatten(table(spark, sf_dir, "events"), "event_id", "props")


@query("SELECT o_orderkey, extract('year' FROM o_orderdate)::INT AS year FROM orders")
def year_from_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", numeric.year_of(F.col("o_orderdate")).alias("year"))


@query(rf"SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title>\s*(.*?)\s*</title>', 1), '{_WS}+', ' ', 'g')), '') AS title FROM pages")
def xml_first(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.xml_first(F.col("html"), "title").alias("title"))


@query(
    rf"""
    WITH p AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<p>\s*(.*?)\s*</p>', 1)) AS x FROM pages),
    q AS (SELECT page_id, trim(regexp_replace(x, '{_WS}+', ' ', 'g')) AS x FROM p)
    SELECT pages.page_id, coalesce(n, 0)::INT AS n FROM pages LEFT JOIN (SELECT page_id, count(DISTINCT x) AS n FROM q WHERE x <> '' GROUP BY 1) USING (page_id)
    """
)
def xml_all(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(text.xml_all(F.col("html"), "p")).alias("n"))


@query(
    """
    WITH r AS (SELECT n_regionkey, [n_nationkey::VARCHAR, n_name] AS r, n_nationkey FROM nation)
    SELECT n_regionkey, '| key | name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || r[1] || ' | ' || r[2] || ' |', chr(10) ORDER BY n_nationkey) AS md FROM r GROUP BY 1
    """
)
def md_table(spark, sf_dir):
    cells = F.array(F.col("n_nationkey").cast("string"), F.col("n_name"))
    d = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", cells.alias("r")))).alias("x"))
    rows = F.concat(F.array(F.array(F.lit("key"), F.lit("name"))), F.transform("x", lambda x: x["r"]))
    return d.select("n_regionkey", text.rows_to_markdown(rows).alias("md"))


@query(
    """
    SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', x::DOUBLE)), ',') || ']' AS v FROM embeddings
    """
)
def vector_text(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", text.vector_text(F.col("embedding")).alias("v"))


@query("SELECT doc_id, text, '{\"path\":\"' || source || '\",\"chunk_index\":' || (doc_id % 7) || '}' AS meta FROM documents")
def chunk_metadata(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text", nested.chunk_metadata(F.col("source"), F.col("doc_id") % 7).alias("meta"))


@query("SELECT conv_id, turn, 'Role: ' || role || chr(10) || text AS prompt FROM conversations")
def prompt_assembly(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.prompt("Role: {{role}}\n{{text}}", role=F.col("role"), text=F.col("text")).alias("prompt"))


def _xml(spark, sf_dir):
    """The documents as publisher XML: a title, one section and one reference per line, and a table."""
    d = table(spark, sf_dir, "documents")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lines = F.split(esc(F.col("text")), "\n")
    secs = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("<ce:section><ce:section-title>S"), i.cast("string"), F.lit("</ce:section-title><ce:para>"), x, F.lit(' <ce:cross-ref refid="bib0001">x</ce:cross-ref></ce:para></ce:section>'))), "")
    t = F.lit("<ce:table><ce:caption>T</ce:caption><ce:row><ce:entry>a</ce:entry><ce:entry>b</ce:entry></ce:row></ce:table>")
    ref = lambda x, i: F.concat(F.format_string('<ce:bib-reference id="bib%04d"><ce:title>', i + 1), x, F.lit("</ce:title><ce:doi>10.1/"), F.concat_ws(".", "doc_id", i + 1), F.lit("</ce:doi></ce:bib-reference>"))
    refs = F.array_join(F.transform(lines, ref), "")
    return d.select("doc_id", F.concat(F.lit("<doc><dc:title>D"), F.col("doc_id").cast("string"), F.lit("</dc:title>"), secs, t, refs, F.lit("</doc>")).alias("xml"))


@query(
    rf"""
    WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS x FROM documents)
    SELECT doc_id, 'section' AS kind, i::INT AS ord, '## S' || (i - 1) || chr(10) || chr(10) || trim(regexp_replace(x, '{_WS}+', ' ', 'g') || ' [1]') AS content FROM l
    UNION ALL SELECT doc_id, 'table_md', 1, '**Caption:** T' || chr(10) || chr(10) || '| a | b |' || chr(10) || '| --- | --- |' FROM documents
    UNION ALL SELECT doc_id, 'title', 0, 'D' || doc_id FROM documents
    """
)
def document_parse(spark, sf_dir):
    return documents.parse_documents(_xml(spark, sf_dir), kinds=("section", "table_md", "title")).select("doc_id", "kind", "ord", "content")


@query(
    rf"""
    WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS x FROM documents)
    SELECT doc_id, i::VARCHAR AS label, trim(regexp_replace(x, '{_WS}+', ' ', 'g')) AS title, '10.1/' || doc_id || '.' || i AS doi FROM l
    """
)
def document_references(spark, sf_dir):
    return documents.references(documents.parse_documents(_xml(spark, sf_dir), kinds=("reference",))).select("doc_id", "label", "title", "doi")


_VECTOR = "list_transform(range(0, 16), lambda i: ((('0x' || substr(sha256({0}), 2 * i + 1, 2))::INT - 128) / 128.0)::FLOAT)"


@query(f"SELECT concat_ws(':', doc_id, chunk_index) AS id, {_VECTOR.format('chunk')} AS embedding FROM ({ORACLES['chunk_documents']})")
def embed_chunks(spark, sf_dir):
    c = chunks.chunk_text(table(spark, sf_dir, "documents")).withColumn("id", F.concat_ws(":", "doc_id", "chunk_index"))
    return models.embed_texts(c, "id", "chunk", models.digest_embedder(16), 16)


@query(f"SELECT doc_id, {_VECTOR.format('text')} AS embedding FROM documents")
def embeddings_once_per_text(spark, sf_dir):
    """Vectors by a result table that two calls share: the second one pays for the texts that the first one lacks."""
    cache = scratch(spark, "results")
    d = table(spark, sf_dir, "documents")
    call = lambda rows: models.once_per_text(rows, "doc_id", "text", models.digest_embedder(16), "array<float>", cache, batch=64)
    call(d.filter("doc_id % 3 = 0"))
    return call(d).select("doc_id", F.col("result").alias("embedding"))


@query("SELECT item_id, '{\"n\": ' || length(text) || '}' AS answer, []::VARCHAR[] AS errors FROM benchmark")
def model_answers(spark, sf_dir):
    d = table(spark, sf_dir, "benchmark")
    return models.call_model(d, "item_id", "text", lambda p: '{"n": %d}' % len(p), lambda x: [] if "n" in x else ["n is missing"])


@query(
    """
    SELECT doc_id, replace(text, '. ', ' ' || CASE WHEN doc_id % 4 = 0 THEN 'as [1,2] and [3,4], [5]' WHEN doc_id % 4 = 1 THEN 'in [12,19,48]' WHEN doc_id % 4 = 2 THEN '[7,8]' ELSE 'none (1)' END || '. ') AS c FROM documents
    """
)
def citation_compress(spark, sf_dir):
    cited = F.expr("CASE WHEN doc_id % 4 = 0 THEN 'as [1], [2] and [3], [4], [5]' WHEN doc_id % 4 = 1 THEN 'in ([12]; [19]; [48])' WHEN doc_id % 4 = 2 THEN '[[7,8]]' ELSE 'none (1)' END")
    raw = F.replace(F.col("text"), F.lit(". "), F.concat(F.lit(" "), cited, F.lit(". ")))
    return table(spark, sf_dir, "documents").select("doc_id", text.compress_citations(raw).alias("c"))
