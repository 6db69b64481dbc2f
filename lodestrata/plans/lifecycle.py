"""The three entry points as compositions of operators: building the corpus, answering from it, evaluating it."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.functions.nested import deep_merge
from lodestrata.functions.numeric import to_float
from lodestrata.functions.text import trim_text
from lodestrata.operators import context, documents, evalsuite, models, normalize, params, retrieval, review
from lodestrata.operators.search import keyword_score_squeezed


def load_config(path: str, profile: str | None = None) -> dict:
    """Settings of a YAML or JSON file, with a profile's merged over them; YAML needs its library."""

    def read(p: str) -> dict:
        raw = Path(p).read_text(encoding="utf-8")
        if p.endswith(".json"):
            return json.loads(raw) or {}
        import yaml

        return yaml.safe_load(raw) or {}

    return deep_merge(read(path), read(profile)) if profile else read(path)


def choose_dois(spark: SparkSession, configured: list[str] | None, local: DataFrame | None, found: DataFrame | None, limit: int = 0) -> DataFrame:
    """The DOIs to work on: the configured ones, else those of local folders, else those that a search found; ``limit`` of them where it is above 0."""
    if configured:
        d = spark.createDataFrame([(k, x) for k, x in enumerate(configured)], "ord int, doi string")
    else:
        d = next((x for x in (local, found) if x is not None and not x.isEmpty()), None)
        if d is None:
            return spark.createDataFrame([], "doi string")
        d = d.withColumn("ord", F.col("doi")) if "ord" not in d.columns else d
    d = d.orderBy("ord")
    return (d.limit(limit) if limit > 0 else d).select("doi")


def contexts(parsed: DataFrame, key: str = "doc_id", most: int = 24_000, section_chars: int = 3_500, table_chars: int = 2_500) -> DataFrame:
    """(key, context) of parsed documents by the rule-based selection: the best sections by their words, then the best tables, within the budget. Documents without relevant parts have no row."""
    kinds = {"section": (context.SECTION_WORDS, section_chars), "abstract": (context.SECTION_WORDS, section_chars), "table_md": (context.TABLE_WORDS, table_chars)}
    out = None
    for kind, (keywords, chars) in kinds.items():
        d = parsed.filter(F.col("kind") == kind).withColumn("score", keyword_score_squeezed(F.col("content"), keywords))
        d = d.filter(context.relevant_section(F.col("score"), F.col("name")) if kind != "table_md" else F.col("score") > 0)
        label = "TABLE" if kind == "table_md" else "SECTION"
        d = d.select(key, F.lit(label.lower()).alias("kind"), "name", "score", context.part(label, F.col("name"), trim_text(F.col("content"), chars, "\n...[TRUNCATED]..."), F.col("score")).alias("part"))
        out = d if out is None else out.unionByName(d)
    out = out.withColumn("len", F.length("part")).withColumn("rank", -F.col("score"))
    kept = context.budget_sections_then_tables(out, key, "kind", ["rank", "name"], "len", most)
    return context.context_text(kept, key, ["kind", "rank", "name"], "part")


def extract(parsed: DataFrame, model: Callable[[str], str], prompt: Callable[[Column], Column], key: str = "doc_id", validate: Callable[[dict], list[str]] | None = None) -> DataFrame:
    """(key, answer, errors): a model's record of each document's context."""
    d = contexts(parsed, key)
    return models.call_model(d.withColumn("prompt", prompt(F.col("context"))), key, "prompt", model, validate)


ITEM = (
    "array<struct<domain:string,canonical_name:string,symbol:string,description:string,value:string,unit:string,reported_value:string,reported_unit:string,confidence:string,"
    "source:struct<origin_type:string,type:string,adopted_from_reference_ids:array<string>,calibration_based_on_reference_ids:array<string>,reference_ids:array<string>,calibration_in_this_study:string,"
    "evidence_text:string,evidence_section:string,evidence_location:struct<kind:string,id:string,page:string>>>>"
)


def parameter_table(records: DataFrame, key: str = "record_id", doc: str = "doc") -> DataFrame:
    """The normalized parameter rows of JSON records: names, units, provenance, evidence, block and index, and review reasons."""
    d = records.select(key, F.from_json(F.get_json_object(doc, "$.parameters.registry"), ITEM).alias("registry"))
    p = params.block_index(params.explode_registry(d, key), key)
    i, s = F.col("item"), F.col("item.source")
    p = p.withColumn("canonical_name", normalize.canonical_name(i["symbol"], i["canonical_name"], i["description"])).withColumn("symbol", params.symbol_of(i))
    p = p.withColumn("x", normalize.normalize_units(i["value"], i["unit"], i["reported_value"], i["reported_unit"]))
    p = p.withColumn("r", normalize.roles(s["adopted_from_reference_ids"], s["calibration_based_on_reference_ids"], s["reference_ids"], s["calibration_in_this_study"]))
    p = p.withColumn("origin_type", normalize.origin_type(s["origin_type"], s["type"]))
    loc = s["evidence_location"]
    p = p.withColumn("evidence", normalize.has_evidence(s["evidence_text"], s["evidence_section"], loc["kind"], loc["id"], loc["page"]))
    p = p.withColumns({"n_adopted": F.size("r.adopted"), "n_calibration": F.size("r.calibration"), "this_study": F.col("r.this_study"), "value": F.coalesce(F.col("x.value").cast("string"), i["value"])})
    c = F.col
    p = p.withColumn("reasons", review.reasons(i["confidence"], c("origin_type"), c("n_adopted"), c("n_calibration"), c("this_study"), c("evidence"), c("symbol"), c("value")))
    return p.select(
        key, "ord", "block", "block_idx", "canonical_name", "symbol", "value", c("x.unit").alias("unit"), c("x.value_si").alias("value_si"), c("x.unit_si").alias("unit_si"), c("x.converted").alias("converted"), "origin_type",
        c("r.adopted").alias("adopted"), c("r.calibration").alias("calibration"), c("r.residual").alias("residual"), "n_adopted", "n_calibration", "this_study", "evidence", "reasons",
    )


def renest(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """Parameter rows back in one JSON text per record, in their order."""
    cols = [c for c in rows.columns if c not in (key, "ord")]
    x = F.sort_array(F.collect_list(F.struct("ord", F.struct(*cols).alias("item"))))
    return rows.groupBy(key).agg(F.to_json(F.struct(F.struct(F.transform(x, lambda r: r["item"]).alias("registry")).alias("parameters"))).alias("doc"))


def answer(chunks: DataFrame, query_vec: DataFrame, question: str, model: Callable[[str], str], k: int = 8) -> DataFrame:
    """(answer, errors) to a question from its k nearest chunks (chunk_id, text, embedding), with the evidence numbered in the prompt."""
    hits = retrieval.vector_topk(chunks, query_vec, k, "chunk_id", "embedding").withColumn("snippet", retrieval.snippet(F.col("text"), 900)).withColumn("o", -F.col("score"))
    p = retrieval.evidence_prompt(hits, question, ["o", "chunk_id"], "snippet").withColumn("q", F.lit(question))
    return models.call_model(p, "q", "prompt", model).select("answer", "errors")


def evaluate(gold: DataFrame, pred: DataFrame, keys: list[str], runs: DataFrame, qrels: DataFrame) -> dict[str, DataFrame]:
    """All metrics of one gold and prediction pair (keys, block, value text, unit, ids) and of retrieval runs, as tables."""

    def rows(d: DataFrame) -> DataFrame:
        return d.withColumn("value", to_float(F.col("value"))).withColumn("n_citations", F.size("ids"))

    g, p = rows(gold), rows(pred)
    m = evalsuite.matched(g, p.drop("block"), keys).withColumnRenamed("g_block", "block")
    out = {
        "numeric": evalsuite.numeric_metrics(m, "block"), "unit": evalsuite.unit_metrics(m, "block"), "citation": evalsuite.citation_metrics(m, "g_ids", "p_ids"), "retrieval": evalsuite.retrieval_metrics(runs, qrels),
        "errors": evalsuite.error_buckets(g, p, keys),
    }
    one = evalsuite.one_row(out["citation"].select(F.col("f1").alias("citation_f1")), out["retrieval"])
    one = one.withColumn("recall", evalsuite.recall_for_gate(F.col("hit_at_10"), F.col("hit_at_5")))
    return out | {"gate": evalsuite.gate(one, [("citation_f1", "ge", 0.55), ("recall", "ge", 0.6)])}


def parse_corpus(docs: DataFrame, key: str = "doc_id", xml: str = "xml") -> DataFrame:
    """Parsed documents, of those that share a key only the first by their text's digest."""
    w = Window.partitionBy(key).orderBy(F.md5(xml))
    return documents.parse_documents(docs.withColumn("_n", F.row_number().over(w)).filter("_n = 1"), key, xml)
