"""What larger tables brought up: long strings, ties in rounding, and work that must not grow faster than its input."""

import os
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from lodestrata.functions import text
from lodestrata.operators import documents, normalize, search
from lodestrata.plans import q_evaluation, q_records
from lodestrata.sources import database

REPO = str(Path(__file__).resolve().parents[1])


def test_a_long_string_stays_whole():
    """The parser hands over a string of more than 8,192 bytes in parts; no space may stand where it was cut."""
    for n in range(8180, 8200):
        root = documents.parse(f"<d><p>{'x' * n}&amp;&amp;&amp;y<b>z</b></p></d>")
        assert root.first(("p",)).text() == "x" * n + "&&&y z"


def test_vector_text_rounds_the_number_itself(spark):
    d = spark.createDataFrame([(0, [0.001953125, None, -0.005859375, 1e22]), (1, []), (2, None), (3, [float("nan"), float("-inf"), -0.0])], "k int, v array<float>")
    got = dict(d.select("k", text.vector_text(F.col("v"))).collect())
    assert got == {0: "[0.00195312,-0.00585938,9999999778196308361216.00000000]", 1: "[]", 2: None, 3: "[nan,-inf,-0.00000000]"}


def test_database_merge_with_executors_of_their_own(tiny, tmp_path):
    """An embedded database is in the driver's process, where tasks of a cluster do not reach it."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from lodestrata.session import build_session
from lodestrata.plans import q_store
s = build_session("cluster", "local-cluster[1,2,1024]", spark__driver__host="127.0.0.1", spark__checkpoint__dir={str(tmp_path)!r}, spark__executor__memory="700m")
a, b = sorted(map(tuple, q_store.database_merge(s, {tiny!r}).collect())), sorted(map(tuple, q_store.upsert_mixed(s, {tiny!r}).collect()))
assert a == b and a, (a[:3], b[:3])
print("equal")
"""
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, cwd=tmp_path, env=os.environ | {"PYTHONPATH": REPO})
    assert "equal" in r.stdout, r.stderr[-2000:]


def test_embedded_database_keeps_every_text(spark, tmp_path):
    url, props = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    with database.connection(spark, url, props) as c:
        database.execute(c, "CREATE TABLE t (k BIGINT PRIMARY KEY, a VARCHAR(40), b DOUBLE)")
    rows = [(-5, ' a "b", c ', 0.1), (2, "", None), (9, None, 1e300), (10, "l\nm\r\n\\", -0.5), (11, "ü,", 3.0), (12, '"', 1e-7)]
    d = spark.createDataFrame(rows, "k long, a string, b double")
    assert database.merge(d, url, "t", ["k"], {"k": "BIGINT", "a": "VARCHAR(40)", "b": "DOUBLE"}, props, embedded=True) == 6
    got = lambda: sorted(map(tuple, database.export_ranges(spark, url, "t", "k", "k long, a string, b double", props, 4).collect()))
    assert got() == rows
    with database.connection(spark, url, props) as c:
        database.execute(c, "DELETE FROM t WHERE k < 100")
    assert got() == []


def test_families_are_met_one_at_a_time(spark):
    """All rules, and no plan in which a parameter carries the list of its record's families."""
    n = 400
    fams = spark.range(n).select(
        F.lit(1).alias("record_id"), F.when(F.col("id") % 2 == 0, "slip").otherwise("twin").alias("kind"), F.col("id").cast("int").alias("ord"), F.concat(F.lit("f"), (F.col("id") / 2).cast("int").cast("string")).alias("fkey"), F.concat(F.lit("F"), F.col("id").cast("string")).alias("family_id"),
        F.lit(None).cast("string").alias("family_name"), F.lit("p").alias("plane_direction"), F.array().cast("array<string>").alias("systems"), F.lit(2).alias("num_systems"), F.when(F.col("id") > 100, "basal_slip").otherwise("twinning").alias("mechanism"),
    )
    other = fams.filter("ord IN (5, 6)").withColumn("record_id", F.lit(2))
    asks = [(1, "f7", None, "x"), (1, " ", "F-7", "basal slip"), (1, None, "f9", None), (1, None, None, "Basal Slip"), (1, None, "", "all_slip"), (2, None, None, "all_slip"), (2, "", None, "twinning"), (2, None, None, "basal_slip"), (3, None, None, "all_slip"), (2, "nix", None, "all_slip")]
    p = spark.createDataFrame([(k, *a) for k, a in enumerate(asks)], "k int, record_id int, family_id string, family_name string, mechanism string")
    d = normalize.choose_family(p, fams.union(other))
    got = {r["k"]: r["family"] and r["family"]["family_id"] for r in d.collect()}
    assert got == {0: "F14", 1: "F102", 2: "F18", 3: "F102", 4: None, 5: "F6", 6: "F5", 7: None, 8: None, 9: None}
    assert "collect_list" not in d._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_parsed_in_short_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    documents.parse_documents(spark.createDataFrame([(1, "<d/>")], "doc_id int, xml string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000


def test_only_what_is_asked_for_is_read_and_once(monkeypatch):
    read, rows = [], documents.table_rows
    monkeypatch.setattr(documents, "table_rows", lambda t, refs: read.append(t.at) or rows(t, refs))
    xml = "<d><sec><title>S</title><p>x</p>" + "<table><caption>C</caption><tr><td>a</td></tr></table>" * 3 + "</sec></d>"
    got = documents.document_rows(xml, kinds=frozenset(("section", "table_md")))
    assert [r[0] for r in got] == ["table_md"] * 3 + ["section"] and got[-1][3].count("### Table") == 1
    assert len(read) == 3
    documents.document_rows(xml, nested=True, kinds=frozenset(("section",)))
    assert len(read) == 3


def test_a_filter_by_keywords_makes_the_text_once(spark):
    d = spark.createDataFrame([(1, " Heat \n Treatment of AN alloy"), (2, None), (3, "x")], "doc_id int, text string")
    d = d.select("doc_id", search.keyword_score_squeezed(F.col("text"), ["heat treatment", "alloy", "Alloy", "", "zinc"]).alias("score")).filter("score > 0")
    assert [tuple(r) for r in d.collect()] == [(1, 3)]
    assert d._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") <= 2  # one in the filter, one in the result


def test_report_tables_searches_once(spark, tiny, monkeypatch):
    calls, search_all = [], q_evaluation._retrieval
    monkeypatch.setattr(q_evaluation, "_retrieval", lambda *a: calls.append(1) or search_all(*a))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert q_evaluation.report_tables(spark, tiny).count() == 1 and len(calls) == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000  # a row may hold a block of vectors


def test_served_pages_do_not_pass_through_the_driver(spark, tiny, monkeypatch):
    def refused(*_):
        raise AssertionError("rows come to the driver")

    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", refused)
    got = q_records.paged_search_stream(spark, tiny)
    assert got.count() == spark.read.parquet(f"{tiny}/part.parquet").count()


def test_small_rows_of_long_work_are_dealt_out_to_several_tasks(spark, tiny):
    from lodestrata.plans import q_normalize
    from lodestrata.session import spread

    assert spark.read.parquet(f"{tiny}/part.parquet").rdd.getNumPartitions() == 1
    assert q_normalize.gold_documents(spark, tiny).rdd.getNumPartitions() == 6
    assert spread(spark.range(3).coalesce(1)).count() == 3
