import json

from pyspark.sql import functions as F
from test_operators import DOC

from lodestrata.operators import documents
from lodestrata.plans import lifecycle


def test_corpus_from_xml_to_answers(spark):
    docs = spark.createDataFrame([(1, DOC.replace("Intro", "Material model")), (1, DOC.replace("Intro", "Material model")), (2, "<doc><sec><title>None</title><p>x</p></sec></doc>")], "doc_id int, xml string")
    parsed = lifecycle.parse_corpus(docs)
    got = {r["doc_id"]: r["context"] for r in lifecycle.contexts(parsed).collect()}
    assert list(got) == [1] and "=== SECTION: 000_Abstract.md (score=0) ===" in got[1] and "Material model" in got[1]
    asked = []

    def model(prompt):
        asked.append(prompt)
        return json.dumps({"n": len(prompt)})

    out = lifecycle.extract(parsed, model, lambda c: F.concat(F.lit("Context: "), c)).collect()
    assert [(r["doc_id"], r["errors"]) for r in out] == [(1, [])] and json.loads(out[0]["answer"])["n"] == len(got[1]) + 9
    unknown = documents.parse_documents(docs, unknown="?").filter("kind = 'section'").first()["content"]
    assert "[?]" in unknown


def test_parameter_table_and_back(spark):
    item = {"symbol": "tau0", "value": None, "reported_value": "12", "reported_unit": "MPa", "domain": "plastic", "confidence": "high", "source": {"type": "Mixed", "adopted_from_reference_ids": ["1", "2"], "calibration_based_on_reference_ids": ["2", "this_study", "3"]}}
    other = {"symbol": "C11", "canonical_name": "c11", "value": "", "source": {"origin_type": "adopted", "evidence_location": {"page": "3"}}}
    d = spark.createDataFrame([("a", json.dumps({"parameters": {"registry": [item, other]}})), ("b", "{}"), ("c", json.dumps({"parameters": {"registry": None}}))], "record_id string, doc string")
    rows = lifecycle.parameter_table(d)
    x, y = rows.orderBy("ord").collect()
    assert (x["canonical_name"], x["value"], x["value_si"], x["origin_type"], x["calibration"], x["this_study"]) == ("crss_initial", "12.0", 12e6, "adopted_then_calibrated", ["3"], True)
    assert (x["reasons"], y["block"], y["block_idx"], y["reasons"]) == (["missing_evidence"], "elastic", 0, ["low_confidence_or_missing_refs"])
    back = json.loads(lifecycle.renest(rows).first()["doc"])
    assert [p["symbol"] for p in back["parameters"]["registry"]] == ["tau0", "C11"]


def test_choices_and_answers(spark, tmp_path):
    assert [r["doi"] for r in lifecycle.choose_dois(spark, ["b", "a"], None, None, 1).collect()] == ["b"]
    local = spark.createDataFrame([("z",), ("y",)], "doi string")
    assert [r["doi"] for r in lifecycle.choose_dois(spark, None, local, None).collect()] == ["y", "z"]
    assert lifecycle.choose_dois(spark, None, local.limit(0), None).count() == 0
    (tmp_path / "a.json").write_text('{"a": {"b": 1}}')
    (tmp_path / "p.json").write_text('{"a": {"c": 2}}')
    assert lifecycle.load_config(str(tmp_path / "a.json"), str(tmp_path / "p.json")) == {"a": {"b": 1, "c": 2}}
    chunks = spark.createDataFrame([(1, "first", [1.0, 0.0]), (2, "second", [0.0, 1.0])], "chunk_id long, text string, embedding array<float>")
    got = lifecycle.answer(chunks, chunks.filter("chunk_id = 2").select(F.col("embedding").alias("query_vec")), "what?", lambda p: json.dumps({"p": p}), 1).first()
    assert json.loads(got["answer"])["p"] == "Question: what?\n\nEvidence:\n[E1] second"


def test_evaluation_tables(spark):
    g = spark.createDataFrame([(1, "p", "10", "pa", ["a"]), (2, "p", "x", "pa", ["b"]), (3, "e", "1", "pa", [])], "k int, block string, value string, unit string, ids array<string>")
    p = spark.createDataFrame([(1, "p", "11", "pa", ["a"]), (2, "p", "2", "mpa", []), (4, "e", "1", "pa", [])], g.schema)
    runs = spark.createDataFrame([("q", "d1", 1), ("q", "d2", 2)], "query_id string, doc_id string, rank int")
    out = lifecycle.evaluate(g, p, ["k"], runs, spark.createDataFrame([("q", "d2")], "query_id string, doc_id string"))
    errors = {r["error_type"]: r["n"] for r in out["errors"].collect()}
    assert errors == {"missing_parameter": 1, "unit_mismatch": 1, "value_mismatch_gt5pct": 1, "non_numeric_value": 1, "missing_citation_link": 1, "spurious_parameter": 1}
    assert out["retrieval"].first()["mrr"] == 0.5 and {r["metric"]: r["passed"] for r in out["gate"].collect()} == {"citation_f1": True, "recall": True}
    assert {r["block"]: r["n"] for r in out["numeric"].collect()} == {"p": 1, "e": 0, "overall": 1}
