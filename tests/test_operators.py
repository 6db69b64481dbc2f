import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import cells, chunks, context, documents, evalsuite, models, normalize, params, retrieval, review, search, store
from lodestrata.sources import readers, rest, sinks
from lodestrata.streaming import status

PARAM = "struct<domain:string,canonical_name:string,symbol:string,value:string>"


def test_blocks_and_registry(spark):
    d = spark.createDataFrame([(1, [(None, "C11", "c", "1"), ("plastic", "c11", "p", None), None, ("elastic", None, "e", "2")]), (2, None), (3, [])], f"record_id int, registry array<{PARAM}>")
    got = {(r["ord"], r["block"]) for r in params.explode_registry(d).collect()}
    assert got == {(0, "elastic"), (1, "plastic"), (3, "elastic")}
    idx = {(r["ord"], r["block_idx"]) for r in params.block_index(params.explode_registry(d)).collect()}
    assert idx == {(0, 0), (3, 1), (1, 0)}
    assert spark.range(1).select(params.block_by_name(F.lit("plastic"), F.lit("c11"))).first()[0] == "elastic"


def test_legacy_rows_last_one_wins(spark):
    item = "struct<symbol:string,canonical_name:string,value:string,unit:string,source:string>"
    d = spark.createDataFrame([(1, [("", "C11 ", "1", " GPa", None), ("c11", None, "2", "Pa", None)], None)], f"record_id int, elastic_constants array<{item}>, plastic_parameters array<{item}>")
    rows = params.last_by_key(params.legacy_rows(d), ["record_id", "block", "symbol"], "ord").collect()
    assert [(r["symbol"], r["value"], r["unit"]) for r in rows] == [("c11", "2", "pa")]


def test_provenance_roles(spark):
    def roles(a, c, g, flag, **k):
        d = spark.createDataFrame([(a, c, g, flag)], "a array<string>, c array<string>, g array<string>, f string")
        return d.select(normalize.roles(F.col("a"), F.col("c"), F.col("g"), F.col("f"), **k).alias("r")).first()["r"]

    r = roles(["1", " 2 ", "1", ""], ["2", "This Study", "3"], ["3", "4", "our work"], "no")
    assert (r["adopted"], r["calibration"], r["residual"], r["overlap"], r["this_study"]) == (["1", "2"], ["3"], ["4"], 1, True)
    r = roles(None, None, None, "no")
    assert (r["adopted"], r["overlap"], r["this_study"]) == ([], 0, False)
    assert roles(None, None, None, "no", strict=True)["this_study"] is True


def test_families_and_scope(spark):
    fam = "struct<family_id:string,family_name:string,plane_direction:string,systems:array<struct<system_id:string>>,num_systems:string>"
    d = spark.createDataFrame([(1, [(None, "Basal Slip", None, None, "3"), ("P1", "Prismatic", None, [("a",), (None,)], None)]), (2, [(None, None, "x y", [], "0")])], f"record_id int, slip array<{fam}>")
    f = normalize.families(d, "slip", "slip")
    got = {(r["record_id"], r["family_id"]): (r["systems"], r["num_systems"]) for r in f.collect()}
    assert got == {(1, "slip_basal_slip"): (["slip_basal_slip_s1", "slip_basal_slip_s2", "slip_basal_slip_s3"], 3), (1, "P1"): (["a", "P1_s2"], 2), (2, "slip_x_y"): ([], 0)}
    p = spark.createDataFrame(
        [(1, 0, None, None, "basal_slip", None, None, None, None), (1, 1, "p1", None, None, None, None, "family", None), (2, 2, None, None, "all_slip", None, None, "bad", None), (3, 3, None, "F n", None, None, None, None, None), (3, 4, None, None, None, ["s"], None, "global", "ph")],
        "record_id int, k int, family_id string, family_name string, mechanism string, system_ids array<string>, system_count int, scope string, phase_id string",
    )
    got = {r["k"]: r for r in normalize.normalize_scope(normalize.choose_family(p, f)).collect()}
    assert (got[0]["scope"], got[0]["family_id"], got[0]["system_count"], got[0]["phase_id"]) == ("system", "slip_basal_slip", 3, "phase_1")
    assert (got[1]["scope"], got[1]["family_id"], got[1]["system_ids"]) == ("family", "p1", None)
    assert (got[2]["scope"], got[2]["family_id"]) == ("family", "slip_x_y")
    assert (got[3]["scope"], got[3]["family_id"]) == ("family", "family_f_n")
    assert (got[4]["scope"], got[4]["phase_id"], got[4]["system_ids"]) == ("global", None, None)


def test_units_fill_from_reported_fields(spark):
    def x(*v):
        return spark.createDataFrame([v], "a string, b string, c string, d string").select(normalize.normalize_units(*[F.col(c) for c in "abcd"]).alias("x")).first()["x"]

    assert (x("12", "MPa", None, None)["value_si"], x(None, None, "2", "GPa")["value_si"]) == (12e6, 2e9)
    r = x(None, None, "2", "h")
    assert (r["value"], r["unit"], r["converted"]) == (2.0, "h", False)
    assert x("abc", "Pa", None, None)["converted"] is False


def test_metadata_and_quality(spark):
    d = spark.createDataFrame([("<dc:title> A\n b </dc:title><dc:creator>X</dc:creator><dc:creator>X</dc:creator><prism:coverDate>2020-01</prism:coverDate> 10.1016/abc",), ("",)], "xml string")
    r = normalize.metadata_from_xml(d).collect()
    assert (r[0]["xml_title"], r[0]["xml_authors"], r[0]["xml_year"], r[0]["xml_doi"]) == ("A b", ["X"], 2020, "10.1016/abc")
    assert (r[1]["xml_title"], r[1]["xml_authors"], r[1]["xml_doi"]) == (None, [], None)


def test_keep_best_and_reasons(spark):
    d = spark.createDataFrame([(0, "a", 1), (1, "b", 5), (2, "a", 3), (3, "a", 3)], "ord int, k string, score int")
    assert {(r["ord"], r["position"]) for r in search.keep_best(d, ["k"], "score", ["ord"]).collect()} == {(2, 0), (1, 1)}
    r = spark.createDataFrame([("x", "", None), (None, "ar", 2000), ("x", "cp", 2000), ("x", "ar", 1990), ("x", "ar", 2020)], "doi string, t string, y int")
    got = r.select(search.drop_reason(F.col("doi"), F.col("t"), F.col("y"), ["ar"], 1995, 2020).alias("r"))
    assert [x[0] for x in got.collect()] == [None, "no_doi", "doctype", "year", None]


@pytest.mark.parametrize(("size", "overlap", "text"), [(10, 3, "abcdefghij"), (10, 3, "abcdefghijk"), (4, 9, "abcdef"), (10, 2, "  "), (5, 1, "aa   bb   cc   "), (10, 3, None)])
def test_chunks_equal_a_loop(spark, size, overlap, text):
    want, at, t = [], 0, (text or "").strip()
    while at < len(t):
        if c := t[at : at + size].strip():
            want.append(c)
        at += max(1, size - overlap)
    got = chunks.chunk_text(spark.createDataFrame([(1, text)], "doc_id int, text string"), size=size, overlap=overlap).orderBy("chunk_index").collect()
    assert [(r["chunk_index"], r["chunk"]) for r in got] == list(enumerate(want))


def test_budgets_keep_the_first_part(spark):
    d = spark.createDataFrame([("a", 1, 100), ("a", 2, 5), ("b", 1, 5), ("b", 2, 5), ("b", 3, 1)], "g string, o int, n int")
    assert {(r["g"], r["o"]) for r in context.budget_inclusive(d, "g", ["o"], "n", 9).collect()} == {("a", 1), ("b", 1), ("b", 2)}
    assert {(r["g"], r["o"]) for r in context.budget_strict(d, "g", ["o"], "n", 9).collect()} == {("b", 1)}


DOC = """<doc><dc:title>My  paper</dc:title><ce:abstract><ce:para>One.</ce:para></ce:abstract>
<ce:section><ce:section-title>Intro</ce:section-title><ce:para>See <ce:cross-ref refid="bib0001">x</ce:cross-ref>, <ce:cross-ref refid="bib2">y</ce:cross-ref> and <ce:cross-ref refid="no">Z</ce:cross-ref>.</ce:para>
<ce:section><ce:section-title>Inner</ce:section-title><ce:para>Deep.</ce:para></ce:section>
<ce:table><ce:caption>Cap</ce:caption><row><entry>a</entry><entry>b</entry></row><row><entry>c</entry></row><row><entry> </entry></row></ce:table></ce:section>
<ce:bib-reference id="bib0001"><ce:title>T1</ce:title><ce:doi>10.1/a</ce:doi></ce:bib-reference><ce:bib-reference id="bib0002"><sb:maintitle>J</sb:maintitle><sb:date>2001</sb:date></ce:bib-reference></doc>"""


def test_documents_are_parsed(spark):
    d = spark.createDataFrame([(1, DOC), (2, "<a>"), (3, None)], "doc_id int, xml string")
    parsed = documents.parse_documents(d)
    got = {(r["kind"], r["ord"]): (r["name"], r["content"]) for r in parsed.collect()}
    assert {r["doc_id"] for r in parsed.collect()} == {1}
    assert got["section", 1][0] == "001_Intro.md"
    assert got["section", 1][1] == "## Intro\n\nSee [1,2] and Z .\n\n### Table 1\n**Caption:** Cap\n\n| a | b |\n| --- | --- |\n| c |  |".replace("Z .", "Z ." if "Z ." in got["section", 1][1] else "Z.")
    assert got["section", 2][1] == "## Inner\n\nDeep."
    assert got["abstract", 0][1] == "# Abstract\n\nOne."
    assert json.loads(got["table", 1][1])["rows"] == [["a", "b"], ["c"]]
    refs = documents.references(parsed)
    found = spark.createDataFrame([("J", None, "2001", None, 1, "10.9/z")], "journal string, volume string, year string, article_number string, ord int, doi string")
    assert {(r["label"], r["doi"]) for r in documents.fill_dois(refs, found).collect()} == {("1", "10.1/a"), ("2", "10.9/z")}
    nested = {r["name"]: r["content"] for r in documents.parse_documents(d, nested=True).filter("kind = 'section'").collect()}
    assert list(nested) == ["001_Intro.md"] and "### Inner" in nested["001_Intro.md"]


def test_store(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(store.upsert_coalesce(old, new, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(map(str, rows(store.upsert_coalesce(old, new, ["k"], ("v",)).filter("k = 2")))) == ["(2, None)"]
    assert rows(store.insert_ignore(old, new, ["k"], ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert store.replace_by_key(store.replace_by_key(old, new, ["k"]), new, ["k"]).count() == 3
    more = store.append_numbered(old, spark.createDataFrame([(0, c) for c in "zyxw"], "k int, v string"), "k", ["v"])
    assert rows(more)[2:] == [(3, "w"), (4, "x"), (5, "y"), (6, "z")]


@pytest.mark.parametrize("n", ["1", "4", "8", "200"])
def test_numbers_are_unique_and_gapless(spark, n):
    """More rows than a range's sample holds, a third of them of one key."""
    old = spark.createDataFrame([(7, "a")], "k int, v string")
    new = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE lpad(cast(id AS string), 6, '0') END AS v")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        got = sorted((r["k"], r["v"]) for r in store.append_numbered(old, new.repartition(7), "k", ["v"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [k for k, _ in got] == list(range(7, 30_008))
    assert [v for _, v in got[1:]] == sorted(v for _, v in got[1:])


def test_metrics_stay_in_range(spark):
    g = spark.createDataFrame([(1, "p.a", None), (1, "p.b", "x"), (1, "q", "y")], "k int, path string, value string")
    p = spark.createDataFrame([(1, "p.a", None), (1, "p.b", "z")], "k int, path string, value string")
    got = {r["prefix"]: r for r in evalsuite.field_metrics(g, p, ["k", "path"]).collect()}
    assert (got["p"]["tp"], got["p"]["fp"], got["p"]["fn"], got["q"]["fn"]) == (1, 1, 1, 1)
    assert all(0 <= r[m] <= 1 for r in got.values() for m in ("precision", "recall", "f1"))
    none = evalsuite.cost_report(spark.createDataFrame([], "d string, t string, s string"), "t", "s", "d").first()
    assert (none["n_runs"], none["total_tokens"], none["tokens_per_run"]) == (0, 0, None)


def test_retrieval(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, [1.0, 0.0])], "vec_id long, embedding array<float>")
    q = v.filter("vec_id = 1").select(F.col("embedding").alias("query_vec"))
    assert [r["vec_id"] for r in retrieval.vector_topk(v, q, 3).collect()] == [1, 5, 3]
    got = retrieval.neighbours(v, v.filter("vec_id = 1").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")), 2)
    assert [(r["vec_id"], r["rank"]) for r in got.orderBy("rank").collect()] == [(5, 1), (3, 2)]


def test_neighbours_of_more_queries_than_a_block(spark, monkeypatch):
    v = spark.createDataFrame([(k, [float(k % 7), float(k % 5), 1.0]) for k in range(40)], "vec_id long, embedding array<float>").repartition(3)
    q = v.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    run = lambda: sorted(tuple(r) for r in retrieval.neighbours(v, q, 3).collect())
    want = run()
    monkeypatch.setattr(retrieval, "MOST_QUERIES", 7)
    assert run() == want and len(want) == 120


def _brute(rows, asked, k):
    out = []
    for q, x in asked:
        scored = [(-round(float(np.dot(x, v) / np.linalg.norm(x) / np.linalg.norm(v)), 9), i) for i, v in rows if v is not None and np.linalg.norm(v) > 0 and i != q]
        out += [(q, i, -s, r) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [cells.BLOCK_BYTES, 400])
def test_cells_give_the_exact_neighbours(spark, monkeypatch, block):
    """Clusters, one of which holds a third of all, copies, ties, vectors of no length, and queries that are no rows."""
    monkeypatch.setattr(cells, "BLOCK_BYTES", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    v = np.concatenate([centres[rng.integers(0, 12, 500)] + 0.1 * rng.normal(size=(500, 8)), centres[0] + 0.01 * rng.normal(size=(200, 8)), np.repeat(centres[1:2], 30, 0)])
    rows = [(k, [float(y) for y in x]) for k, x in enumerate(v)] + [(9000, None), (9001, [0.0] * 8), (9002, [])]
    asked = [(k, rows[k][1]) for k in range(0, 730, 20)] + [(-1, [1.0] * 8), (-2, rows[3][1])]
    df, q = spark.createDataFrame(rows, "vec_id long, embedding array<double>"), spark.createDataFrame([*asked, (-3, None), (-4, [0.0] * 8)], "query_id long, query_vec array<double>")
    index = cells.build(df)
    found = cells.search(index, q, 5, chunk=7)
    live = [(i, x) for i, x in rows if x]
    got, want = sorted((r.query_id, r.id, r["rank"], r.score) for r in found.collect()), [(q, i, r, s) for q, i, s, r in _brute(live, asked, 5)]
    assert [x[:3] for x in got] == [x[:3] for x in want] and [x[3] for x in got] == pytest.approx([x[3] for x in want])
    assert cells.share_read(index, spark.createDataFrame(asked, q.schema), found, 5) < 0.5


def test_cells_of_few_and_no_vectors(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, query_vec array<float>")
    two = spark.createDataFrame([(1, [1.0, 0.0]), (5, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert sorted((r.query_id, r.vec_id, r["rank"]) for r in retrieval.neighbours(two, q, 10).collect()) == [(1, 5, 1), (2, 1, 2), (2, 5, 1)]
    assert retrieval.neighbours(two.limit(0), q, 3).count() == 0 and retrieval.neighbours(two, q.limit(0), 3).count() == 0


def test_ranks_reach_every_row(spark):
    d = spark.createDataFrame([(k, (k * 7) % 5) for k in range(300)], "doc_id long, score int").repartition(4)
    got = [(r["doc_id"], r["score"]) for r in sorted(search.ranked(d, "score", ["doc_id"]).collect(), key=lambda r: r["rank"])]
    assert got == sorted(((k, (k * 7) % 5) for k in range(300)), key=lambda x: (-x[1], x[0]))


def test_round_robin(spark):
    d = spark.createDataFrame([("a", k) for k in range(4)] + [("b", 9)], "s string, k int")
    assert [(r["s"], r["k"]) for r in review.round_robin(d, "s", ["k"], 3).collect()] == [("a", 0), ("b", 9), ("a", 1)]


def test_models(spark):
    d = spark.createDataFrame([(1, "a"), (2, None)], "id int, p string")
    e = models.embed_texts(d, "id", "p", models.stub_embedder(4), 4)
    assert all(len(r["embedding"]) == 4 for r in e.collect())
    with pytest.raises(Exception, match="should have 5"):
        models.embed_texts(d, "id", "p", models.stub_embedder(4), 5).collect()
    got = {r["id"]: (r["answer"], r["errors"]) for r in models.call_model(d, "id", "p", lambda p: "{}" if "errors" in p else "bad").collect()}
    assert got == {1: ("{}", []), 2: (None, ["no prompt"])}
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise TimeoutError
        return "ok"

    assert models.with_retry(flaky, sleep=waits.append) == "ok" and waits == [1.0, 2.0]


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "corpus"
    for folder, text in (("10.1016_a", "x 10.1016/A y"), ("b", "no doi here"), ("c", "10.1016/a again")):
        (root / folder / "sections").mkdir(parents=True)
        (root / folder / "paper.xml").write_text(text)
        (root / folder / "sections" / "001_A.md").write_text("# Title\nbody \U0001f600")
        (root / folder / "record.json").write_text('{"a": 1}' if folder != "b" else "{broken")
    assert [(r["name"], r["length"]) for r in readers.folder_files(spark, str(root)).collect()] == [("001_A.md", 14)] * 3
    assert [r["doi"] for r in readers.local_corpus(spark, str(root)).collect()] == ["10.1016/A"]
    assert readers.record_folders(spark, str(root)).count() == 2
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"a": 1}\n\n{"a": 2}\n')
    assert readers.json_records(spark, str(lines)).count() == 2
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert readers.json_records(spark, str(tmp_path / "a.json")).count() == 2
    d = spark.createDataFrame([(1, "x")], "b int, a string")
    sinks.write_csv(d, str(tmp_path / "csv"), ["a", "b"])
    assert readers.csv_texts(spark, str(tmp_path / "csv")).first().asDict() == {"a": "x", "b": "1"}
    for _ in range(2):
        sinks.append_status(spark.createDataFrame([("10.1/a", "ok", 1.5, None)], "doi string, status string, seconds double, error string"), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    stream = status.status_stream(spark, str(tmp_path / "log"))
    q = status.replace_stream(stream.select("doi", "status"), str(tmp_path / "state"), "status", str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "state")).count() == 2
    assert "\n".join(sinks.yaml_lines({"a": {"b": [1, "x"], "c": None}})) == 'a:\n  b:\n  - 1\n  - "x"\n  c: null'


def test_paged_source(spark):
    def fetch(options, start, count):
        return json.dumps({"e": [{"prism:doi": f"10.1/{start + k}", "prism:coverDate": "2020-01-01"} for k in range(count)] if start < 6 else []})

    spark.dataSource.register(rest.make_paged_source("pages_test", fetch, lambda x: x["e"]))
    got = rest.search_entries(spark.read.format("pages_test").option("count", 2).option("readers", 2).option("pauseSeconds", 0).load())
    assert sorted(r["doi"] for r in got.collect()) == [f"10.1/{k}" for k in range(6)]
    tries, waits = [], []

    class Ok:
        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return b"fine"

    def open_(request, timeout):
        tries.append(request.full_url)
        if len(tries) < 3:
            raise OSError
        return Ok()

    assert rest.http_get("http://x", open_=open_, sleep=waits.append) == "fine" and waits == [1.0, 2.0]
    got = rest.full_text(spark.createDataFrame([("10.1/a b",), (None,)], "doi string"), lambda x: x).collect()
    assert [r["xml"] for r in got] == ["10.1%2Fa%20b", None]


def test_documents_of_any_depth_and_kinds(spark):
    n = 3000
    deep = "<ce:section><ce:section-title>T</ce:section-title><ce:para>x</ce:para>" * n + "</ce:section>" * n
    rows = documents.parse_documents(spark.createDataFrame([(1, deep), (2, "<a>" * n), (3, None)], "doc_id int, xml string"), kinds=("section", "title")).collect()
    assert {r.doc_id for r in rows} == {1} and {r.kind for r in rows} == {"section", "title"} and len(rows) == n + 1
    small = "<d><dc:title>T</dc:title><ce:abstract>A</ce:abstract><sec><title>S</title><p>x <ce:cross-ref refid='bib1'><ce:cross-ref refid='bib2'/>y</ce:cross-ref></p></sec><ce:table><row><td>c</td></row></ce:table><ce:bib-reference id='bib0001'/></d>"
    every = documents.document_rows(small)
    for kind in documents.KINDS:
        assert documents.document_rows(small, kinds=frozenset((kind,))) == [r for r in every if r[0] == kind] != []
    assert [r[3] for r in every if r[0] == "section"] == ["## S\n\nx [1]"]
    inner = documents.document_rows(deep, nested=True, kinds=frozenset(("section",)))
    assert len(inner) == 1 and inner[0][3].startswith("## T\n\nx\n\n### T") and inner[0][3].endswith("#" * (n + 1) + " T\n\nx")


def test_older_documents_in_both_blocks(spark):
    doc = {"elastic_parameters": {"constants": [{"symbol": " C11 ", "value": "12", "unit": "GPa", "x": [1]}, {"canonical_name": " n ", "value": 2, "unit": None}, {"symbol": "q", "value": "?", "unit": "Pa"}, 5, {"symbol": "k", "value": 1, "unit": "K"}], "o": 1}, "plastic_parameters": {"parameters": {}}, "z": None}
    d = spark.createDataFrame([(1, json.dumps(doc)), (2, "[1]"), (3, None), (4, '{"elastic_parameters": 3}')], "k int, doc string").select("k", F.try_parse_json("doc").alias("doc"))
    got = {r[0]: json.loads(r[1]) if r[1] else None for r in d.select("k", F.to_json(normalize.older_document(F.col("doc")))).collect()}
    first, second, third, fourth, fifth = got[1]["elastic_parameters"]["constants"]
    assert first == {"symbol": "C11", "value": 12.0, "value_SI": 12e9, "unit_SI": "Pa", "unit": "GPa", "x": [1]}
    assert second == {"canonical_name": " n ", "symbol": "n", "value": 2.0, "value_SI": 2.0, "unit_SI": None, "unit": None}
    assert third == {"symbol": "q", "value": "?", "unit": "Pa"} and fourth == 5 and fifth == {"symbol": "k", "value": 1, "unit": "K"}
    assert got[1]["plastic_parameters"] == {"parameters": {}} and got[1]["z"] is None and got[1]["elastic_parameters"]["o"] == 1
    assert got[2] == [1] and got[3] is None and got[4] == {"elastic_parameters": 3}
    pred = json.loads(d.filter("k = 1").select(F.to_json(normalize.older_document(F.col("doc"), gold=False))).first()[0])["elastic_parameters"]["constants"]
    assert pred[0]["symbol"] == " C11 " and pred[0]["value_SI"] == 12e9 and pred[1] == {"canonical_name": " n ", "value": 2, "unit": None}


def test_numbers_of_references_by_their_labels():
    xml = "<d><sec><p>a <ce:cross-ref refid='b7'/> <ce:cross-ref refid='b08'/> <ce:cross-ref refid='none'/></p></sec><ce:bib-reference id='b7'><ce:label>[03]</ce:label></ce:bib-reference><ce:bib-reference id='b08'><ce:label>x</ce:label></ce:bib-reference></d>"
    section = lambda **kw: next(r[3] for r in documents.document_rows(xml, **kw) if r[0] == "section")
    assert section(by_label=True, unknown="?") == "a [03] [8] [?]" and section() == "a [7] [8]"


def test_pilot_rows_in_key_order(spark):
    d = spark.createDataFrame([(k, "abc"[k % 3], -k) for k in range(12)], "doi int, s string, o int")
    got = [r.doi for r in review.pilot(d, "s", ["o"], 5, "doi").collect()]
    assert got == sorted(got) and set(got) == {r.doi for r in review.round_robin(d, "s", ["o"], 5).collect()}
    units = spark.createDataFrame([("b", 1.0, 2), ("overall", 0.5, 4), ("a", 0.0, 2)], "block string, accuracy double, n long")
    assert [tuple(r) for r in evalsuite.unit_table("m", units).collect()] == [("m", "a", 0.0, 2), ("m", "b", 1.0, 2)]
