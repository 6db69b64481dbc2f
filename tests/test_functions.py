import json

from pyspark.sql import functions as F

from lodestrata.functions import nested, numeric, text
from lodestrata.operators.documents import compress


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, text.norm_text(lit(" A\u00a0 b\nC "))) == "a b c"
    assert one(spark, text.norm_text(lit(None).cast("string"))) == ""
    assert one(spark, text.strip(lit("\n\t a \u2003"))) == "a"
    assert one(spark, text.safe_filename(lit("a/b: " + "x" * 100))) == ("a_b_ " + "x" * 100)[:80]
    assert one(spark, text.safe_filename(lit("  "))) == "Untitled"
    assert one(spark, text.slug(lit(" Basal--Slip <a> "))) == "basal_slip_<a>"
    assert one(spark, text.trim_text(lit(" abcd "), 4)) == "abcd"
    assert one(spark, text.trim_text(lit("abcde"), 4)) == "abcd...[TRUNCATED]..."
    assert one(spark, text.first_doi(lit("see 10.1016/j.ab.2020(1) and 10.1/x"))) == "10.1016/j.ab.2020(1)"
    assert one(spark, text.first_doi(lit("none"))) is None
    assert one(spark, text.journal_key(lit("10.1016/j.actamat.2020"))) == "actamat"
    assert one(spark, text.ref_number(lit("bib0012"))) == 12
    assert one(spark, text.bibliographic(lit("J"), lit(None).cast("string"), lit(2020), lit("7"))) == "J (2020) 7"
    assert one(spark, text.rows_to_markdown(F.array(F.array(lit("a"), lit("b")), F.array(lit("c"))))) == "| a | b |\n| --- | --- |\n| c |  |"
    assert one(spark, text.rows_to_markdown(F.array().cast("array<array<string>>"))) == ""
    assert one(spark, text.xml_all(lit("<a>x</a><a> y\nz </a><a>x</a>"), "a")) == ["x", "y z"]
    assert one(spark, text.xml_first(lit('<a id="1">x</a>'), "a")) is None
    assert one(spark, text.family_mechanism(lit("Tensile Twin"))) == "twinning"
    assert one(spark, text.first_line_title(lit("## A title \nrest"))) == "A title"


def test_citations_are_compressed_alike_in_columns_and_in_the_parser(spark):
    for raw, want in {
        "([12]; [19]; [48])": "[12,19,48]", "[1], [2], [3]": "[1,2], [3]", "[[12,19]]": "[12,19]", "a ([1]) b ([2], [3]) c": "a [1] b [2,3] c", "(see [1])": "(see [1])", "": "",
    }.items():
        assert one(spark, text.compress_citations(F.lit(raw))) == want
        assert compress(raw) == want


def test_numbers(spark):
    lit = F.lit
    for raw, want in {"12": 12.0, " 1e3 ": 1000.0, "1_000": 1000.0, "1d": None, "": None, "x": None, "-.5": -0.5}.items():
        assert one(spark, numeric.to_float(lit(raw))) == want
    assert one(spark, numeric.int_or_zero(lit("12.0"))) == 0
    assert one(spark, numeric.int_or_zero(lit(" 7 "))) == 7
    assert one(spark, numeric.factor(lit(" GPa "))) == 1e9
    assert one(spark, numeric.factor(lit("s^-1"))) is None
    assert one(spark, numeric.factor(lit(""), numeric.GOLD_UNITS)) == 1.0
    assert one(spark, numeric.year_of(lit("2020-01-02"))) == 2020
    assert one(spark, numeric.year_of(lit("May 2020"))) is None
    assert one(spark, numeric.almost_equal(lit(1.0), lit(1.0 + 1e-7))) is True
    p, r, f = numeric.prf(lit(0), lit(0), lit(0))
    assert (one(spark, p), one(spark, r), one(spark, f)) == (0.0, 0.0, 0.0)


def test_nested_documents(spark):
    node = nested.skeleton('Reply like {"a": {"b": null}, "l": [{"c": 1}], "s": null} please')
    d = spark.createDataFrame([(1, '{"a": {"b": "x"}, "l": [{"c": 2}], "extra": 1}'), (2, "[1]"), (3, None), (4, '{"a": 3, "l": {}}')], "record_id int, doc string")
    got = {r["record_id"]: r["x"] for r in d.select("record_id", nested.coerce(F.col("doc"), node).alias("x")).collect()}
    assert got[1]["a"]["b"] == "x" and got[1]["l"][0]["c"] == "2" and got[3]["l"] == []
    issues = {(r[0], r[1], r[2]) for r in nested.problems(d, node).collect()}
    assert (1, "s", "missing") in issues and (4, "a", "not an object") in issues and (4, "l", "not a list") in issues and (2, "a", "missing") in issues
    flat = {(r[1], r[2]) for r in nested.flatten(spark.createDataFrame([(1, '{"a": [{"b": 1}, {}], "c": null, "e": []}'), (2, "bad")], "record_id int, doc string")).collect()}
    assert flat == {("a[0].b", "1"), ("c", None)}
    kept = nested.strip_internal(spark.createDataFrame([('{"_x": 1, "a": [{"_y": 2, "b": 3}]}',), ("no",), (None,)], "doc string")).collect()
    assert [r[0] for r in kept] == ['{"a": [{"b": 3}]}', "no", None]
    assert nested.deep_merge({"a": {"b": 1, "c": 2}, "d": [1]}, {"a": {"b": 3}, "d": [2]}) == {"a": {"b": 3, "c": 2}, "d": [2]}


NODE = nested.skeleton('{"p": {"registry": [{"id": "", "ids": [""], "at": {"kind": "", "pages": [{"n": 0}]}}], "n": 0}, "any": [], "s": ""}')


def _shaped(node, x):
    if isinstance(node, dict):
        x = x if isinstance(x, dict) else {}
        return {k: _shaped(v, x.get(k)) for k, v in node.items()} | {k: v for k, v in x.items() if k not in node}
    if isinstance(node, list):
        return [] if not isinstance(x, list) else [_shaped(node[0], v) for v in x] if node else x
    return x


def _at_fault(node, x, path=""):
    if isinstance(node, dict):
        if not isinstance(x, dict):
            return [f"{path or 'root'} must be an object"]
        return [f for k, v in node.items() for f in _at_fault(v, x.get(k), f"{path}.{k}" if path else k)]
    if isinstance(node, list):
        if not isinstance(x, list):
            return [f"{path} must be a list"]
        return [f for i, v in enumerate(x) for f in _at_fault(node[0], v, f"{path}[{i}]")] if node else []
    return []


RECORDS = [
    {"p": {"registry": 7, "n": 1, "extra": 5}, "x": 2}, {}, {"p": {"registry": [{"ids": "no"}, 3, None, {"id": "a", "ids": ["b", 1], "at": {"pages": [{"n": 1}, {}, 4], "more": {"k": [1]}}}]}, "any": [{"b": 1}, 2], "s": [1]},
    {"p": [], "any": {}, "s": {"t": 1}}, {"p": {"registry": []}, "any": [], "s": None, "elastic_parameters": {"constants": 3}}, {"p": None},
]


def test_records_take_a_shape_at_every_depth(spark):
    d = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(RECORDS)] + [(90, None), (91, "no json"), (92, "[1]"), (93, "null")], "record_id int, doc string")
    got = {r[0]: json.loads(r[1]) for r in d.select("record_id", F.to_json(nested.coerced(F.try_parse_json("doc"), NODE))).collect()}
    assert got == {**{k: _shaped(NODE, r) for k, r in enumerate(RECORDS)}, **{k: _shaped(NODE, None) for k in (90, 91, 92, 93)}}
    typed = {r[0]: r[1] for r in d.select("record_id", nested.coerce(F.col("doc"), NODE)).collect()}
    assert typed[2]["p"]["registry"][3]["ids"] == ["b", "1"] and typed[1]["p"]["registry"] == [] and typed[0]["p"]["n"] == "1" and typed[2]["p"]["registry"][1]["at"]["pages"] == []


def test_faults_carry_paths_and_places_in_lists(spark):
    d = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(RECORDS)] + [(90, None), (91, "no json"), (92, "[1]")], "record_id int, doc string")
    got = {}
    for r in nested.faults(d, NODE).orderBy("record_id", "ord").collect():
        got.setdefault(r.record_id, []).append(r.fault)
    want = {k: f for k, r in enumerate(RECORDS) if (f := [f"missing top-level key: {x}" for x in NODE if x not in r] + _at_fault(NODE, r))}
    assert got == {**want, **{k: ["payload is not an object"] for k in (90, 91, 92)}}
    assert "p.registry[3].at.pages[2] must be an object" in got[2]


def test_faults_of_parameter_lists_of_both_kinds(spark):
    node = {"parameters": {"registry": [""]}}
    rows = [{"parameters": {"registry": 1}, "elastic_parameters": {"constants": 2}}, {"parameters": {"registry": 1}, "elastic_parameters": {"constants": []}, "plastic_parameters": {"parameters": "x"}}, {"parameters": {}}]
    d = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "record_id int, doc string")
    got = sorted((r.record_id, r.ord, r.fault) for r in nested.faults(d, node).collect())
    wrong = "parameters.registry must be a list"
    assert got == [(0, 0, "elastic_parameters.constants must be a list"), (0, 1, wrong), (1, 0, "plastic_parameters.parameters must be a list"), (1, 1, wrong), (2, 0, wrong)]


def _leaves(x, path=""):
    if isinstance(x, dict):
        return [y for k, v in x.items() for y in _leaves(v, f"{path}.{k}" if path else k)]
    if isinstance(x, list):
        return [y for i, v in enumerate(x) for y in _leaves(v, f"{path}[{i}]")]
    return [(path, None if x is None else x if isinstance(x, str) else json.dumps(x))]


def _without(x):
    if isinstance(x, dict):
        return {k: _without(v) for k, v in x.items() if not k.startswith("_")}
    return [_without(v) for v in x] if isinstance(x, list) else x


def test_flatten_and_strip_at_any_depth(spark):
    far = {"_x": 1, "k": "end"}
    for k in range(40):
        far = {"a": far, "_b": {"c": 1}} if k % 3 else [far, k]
    rows = [*RECORDS, far, {"a.b": {"_k": {"d": 1}, "t": "x {[ \" ] _y", "l": [[], [[1.5, True]], {}]}}, [], 5, "text", {"_only": 1}]
    deep = '{"a":' * 2000 + "1" + "}" * 2000
    d = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)] + [(90, None), (91, "no _json"), (92, deep)], "record_id int, doc string")
    assert sorted(map(tuple, nested.flatten(d).collect()), key=repr) == sorted(((k, *x) for k, r in enumerate(rows) for x in _leaves(r)), key=repr)
    got = {r.record_id: r.doc for r in nested.strip_internal(d).collect()}
    assert {k: json.loads(v) for k, v in got.items() if k < 90} == {k: _without(r) for k, r in enumerate(rows)}
    assert (got[90], got[91], got[92]) == (None, "no _json", deep)


def test_citations_in_any_number_of_brackets(spark):
    for raw in ("[[[[[1]]]]]", "[[1]", "[[[1,2]] x", "([1]; [2]) [[ [3] ]]", "a", "", "[[[[[[[[7; 8]]]]]]]] [1], [2]"):
        assert one(spark, text.compress_citations(F.lit(raw))) == {"[[[1,2]] x": "[[1,2] x", "([1]; [2]) [[ [3] ]]": "[1,2] [3]"}.get(raw, compress(raw)), raw
    assert one(spark, text.compress_citations(F.lit(None).cast("string"))) is None


def test_flatten_opens_levels_by_a_generator_over_the_values_themselves(spark):
    """No level makes maps and lists of all values, leaves of upper levels included; texts that look like empty objects stay, empty objects do not."""
    texts = ['{"a":"{}","b":"[]","c":{},"d":[],"e":[null,[{}],"",{"":{"x.y":1}}]}', "3", "null", '"[x]"', "[[1,2],[]]", '{"q\\\\\\"{[":[{"]}":[[7]]}]}', "{", None]
    d = spark.createDataFrame(list(enumerate(texts)), "record_id int, doc string")
    flat = nested.flatten(d)
    want = [(k, *x) for k, t in enumerate(texts[:6]) for x in _leaves(json.loads(t))]
    assert sorted(map(tuple, flat.collect()), key=repr) == sorted(want, key=repr)
    assert [r[0] for r in d.limit(6).select(nested.depth(F.col("doc"))).collect()] == [4, 0, 0, 0, 2, 5]
    assert "map_entries" not in flat._jdf.queryExecution().optimizedPlan().toString()
