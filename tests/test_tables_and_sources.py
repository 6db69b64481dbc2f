import itertools
import json
import random
import re

from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.operators import evalsuite, infix, keyed, models, retrieval
from lodestrata.sources import database, rest

# ---- tables in buckets of their key

COLS = "k long, a string, b double"


def _files(path):
    return {p.relative_to(path): p.read_bytes() for p in Path(path).rglob("part-*.parquet")}


def _bucket(name):
    return int(re.search(r"_bucket=(\d+)", str(name))[1])


def test_a_change_leaves_other_buckets_alone(spark, tmp_path):
    t = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=8)
    t.create(spark.createDataFrame([(k, f"a{k}", float(k)) for k in range(100)] + [(None, "null", 0.0)], COLS))
    before = _files(tmp_path / "t")
    new = spark.createDataFrame([(3, None, 33.0), (500, "new", None)], COLS)
    for _ in range(2):
        touched = t.upsert(new)
        after = _files(tmp_path / "t")
        assert 1 <= len(touched) <= 2
        assert {k: v for k, v in after.items() if _bucket(k) not in touched} == {k: v for k, v in before.items() if _bucket(k) not in touched}
        rows = {r.k: (r.a, r.b) for r in t.read().collect()}
        assert len(rows) == 102 and rows[3] == ("a3", 33.0) and rows[500] == ("new", None) and rows[4] == ("a4", 4.0)
    assert t.change(new.limit(0), lambda old, n: old) == [] and _files(tmp_path / "t") == after
    t.upsert(spark.createDataFrame([(3, None, None)], COLS), overwrite=("a",))
    assert t.read().filter("k = 3").select("a", "b").first() == (None, 33.0)


def test_every_rule_on_buckets(spark, tmp_path):
    t = keyed.KeyedTable(spark, str(tmp_path / "t"), ["k"], buckets=4, files=3)
    t.create(spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "z", 3.0)], COLS))
    state = lambda: sorted(tuple(r) for r in t.read().collect())
    t.replace(spark.createDataFrame([(1, "w", 9.0), (7, "v", 8.0)], COLS))
    assert state() == [(1, "w", 9.0), (2, "z", 3.0), (7, "v", 8.0)]
    t.insert_ignore(spark.createDataFrame([(1, "no", 0.0), (8, "b", 1.0), (8, "a", 2.0)], COLS), ["a"])
    assert state() == [(1, "w", 9.0), (2, "z", 3.0), (7, "v", 8.0), (8, "a", 2.0)]
    t.overwrite(spark.createDataFrame([(2, None, None)], COLS))
    t.update(spark.createDataFrame([(7, "u", None), (99, "none", None)], COLS), "a")
    assert state() == [(1, "w", 9.0), (2, None, None), (7, "u", 8.0), (8, "a", 2.0)]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        t.create(t.read())


# ---- a database

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
TYPES = {"k": "BIGINT", "a": "VARCHAR(20)", "b": "DOUBLE"}


def test_database_merges_as_a_whole_or_not_at_all(spark):
    url = "jdbc:derby:memory:merge_test;create=true"
    with database.connection(spark, url, DRIVER) as c:
        database.execute(c, "CREATE TABLE t (k BIGINT PRIMARY KEY, a VARCHAR(20), b DOUBLE CHECK (b < 100))")
    state = lambda: sorted(tuple(r) for r in database.read_ranges(spark, url, "t", "k", DRIVER, 3).collect())
    assert state() == []
    first = spark.createDataFrame([(k, f"a{k}", float(k)) for k in range(20)], COLS)
    assert database.merge(first, url, "t", ["k"], TYPES, DRIVER) == 20
    new = spark.createDataFrame([(3, None, 33.0), (50, "n", None)], COLS)
    for _ in range(2):
        database.merge(new, url, "t", ["k"], TYPES, DRIVER)
        assert len(state()) == 21 and (3, "a3", 33.0) in state() and (50, "n", None) in state()
    database.merge(spark.createDataFrame([(3, "no", 1.0), (51, "y", 1.0)], COLS), url, "t", ["k"], TYPES, DRIVER, ignore=True)
    assert (3, "a3", 33.0) in state() and (51, "y", 1.0) in state()
    held = state()
    with pytest.raises(Exception, match="(?i)check"):
        database.merge(spark.createDataFrame([(4, "z", 5.0), (5, "z", 500.0)], COLS), url, "t", ["k"], TYPES, DRIVER)
    assert state() == held
    with database.connection(spark, url, DRIVER) as c:
        (left,) = database.execute(c, "DELETE FROM t WHERE k >= 0")
    assert left == 22
    tables = spark.read.format("jdbc").options(url=url, dbtable="(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') x", **DRIVER).load()
    assert [r[0] for r in tables.collect()] == ["T"]


def test_database_ranges_are_several_tasks(spark):
    url = "jdbc:derby:memory:range_test;create=true"
    with database.connection(spark, url, DRIVER) as c:
        database.execute(c, "CREATE TABLE t (k BIGINT PRIMARY KEY, a VARCHAR(20), b DOUBLE)")
    database.merge(spark.range(40).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit(1.0).alias("b")), url, "t", ["k"], TYPES, DRIVER)
    d = database.read_ranges(spark, url, "t", "k", DRIVER, 4)
    assert d.rdd.getNumPartitions() == 4 and d.count() == 40


# ---- a paged source as a stream


def test_a_stream_of_pages_goes_on_after_a_failure(spark, tmp_path):
    folder = str(tmp_path)
    (tmp_path / "served").mkdir()
    for k in range(7):
        (tmp_path / "served" / f"{k}.json").write_text(json.dumps([f"e{k}.{j}" for j in range(3 if k < 6 else 1)]))

    def fetch(options, start, count):
        page = Path(folder) / "served" / f"{start // 3}.json"
        if start // 3 == 4 and count > 1 and not (Path(folder) / "healed").exists():
            raise OSError("the server is gone")
        with open(f"{folder}/log", "a") as f:
            f.write(f"{start // 3}:{count}\n")
        return json.dumps({"entries": json.loads(page.read_text())[:count] if page.exists() else []})

    spark.dataSource.register(rest.make_paged_source("paged_test", fetch, lambda d: d["entries"]))

    def run():
        s = spark.readStream.format("paged_test").option("count", 3).option("pagesPerBatch", 2).option("pauseSeconds", 0).load()
        q = s.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    with pytest.raises(Exception, match="the server is gone"):
        run()
    done = {r.page for r in spark.read.parquet(f"{folder}/out").collect()}
    assert done == {0, 1, 2, 3}
    (tmp_path / "healed").touch()
    (tmp_path / "log").unlink()
    run()
    rows = [(r.page, r.ord, json.loads(r.entry)) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(rows) == [(k, j, f"e{k}.{j}") for k in range(7) for j in range(3 if k < 6 else 1)]
    read_again = [x for x in (tmp_path / "log").read_text().split() if x.endswith(":3") and int(x[0]) < 4]
    assert read_again == []
    (tmp_path / "served" / "7.json").write_text(json.dumps(["late"]))
    run()
    assert spark.read.parquet(f"{folder}/out").filter("page = 7").count() == 1


# ---- models


def test_a_text_is_paid_for_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(texts):
        with open(log, "a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        return [t.upper() for t in texts]

    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "k int, t string").repartition(3)
    run = lambda d: sorted((r.k, r.result) for r in models.once_per_text(d, "k", "t", call, "string", str(tmp_path / "cache"), batch=2).collect())
    assert run(rows) == [(1, "A"), (2, "B"), (3, "A"), (4, ""), (5, "")]
    assert sorted(Path(log).read_text().split("\n")[:-1]) == ["", "a", "b"]
    assert run(rows.union(spark.createDataFrame([(6, "c")], rows.schema))) == [(1, "A"), (2, "B"), (3, "A"), (4, ""), (5, ""), (6, "C")]
    assert sorted(Path(log).read_text().split("\n")[:-1]) == ["", "a", "b", "c"]
    with pytest.raises(Exception, match="1 texts, 0 results"):
        models.once_per_text(rows.withColumn("t", F.lit("new")), "k", "t", lambda ts: [], "string", str(tmp_path / "cache"))


def test_calls_run_side_by_side_and_at_a_pace(spark, tmp_path):
    now, slept = [0.0], []
    pace = models.Pace(4, clock=lambda: now[0], sleep=slept.append)
    for _ in range(3):
        pace.wait()
    assert slept == [0.25, 0.5]
    models.Pace(0, sleep=slept.append).wait()
    assert len(slept) == 2

    def call(texts):
        import threading
        import time

        time.sleep(0.2)
        return [str(threading.active_count()) for _ in texts]

    rows = spark.range(8).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t")).coalesce(1)
    got = models.once_per_text(rows, "k", "t", call, "string", str(tmp_path / "c"), workers=4)
    assert max(int(r.result) for r in got.collect()) >= 4


# ---- infix search


def _like(pattern, text):
    out, k = "", 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\" and k + 1 < len(pattern):
            out, k = out + re.escape(pattern[k + 1]), k + 1
        else:
            out += ".*" if c == "%" else "." if c == "_" else re.escape(c)
        k += 1
    return re.search(out, text, re.S | re.I) is not None


def test_infix_search_equals_a_scan_for_any_pattern(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abAB é%_.\n") for _ in range(rng.randrange(12))) for _ in range(150)] + ["", None, "abc" * 5000, "x😀yz", "Straßen"]
    rows = list(enumerate(texts))
    patterns = ["a", "ab", "aba", "abab", "a%b", "a_b", "", "%", "_", "é", "%a%b%", r"\%", r"\_a", "zzz", "😀", "x_yz", "B é", "abcabcabc", "\n", "___", None]
    index = infix.build(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    asked = spark.createDataFrame(list(enumerate(patterns)), "query_id int, pattern string")
    got = sorted((r.query_id, r.doc_id) for r in infix.search(index, asked).collect())
    want = sorted((q, i) for (q, p), (i, t) in itertools.product(enumerate(patterns), rows) if p is not None and t is not None and _like(p, t))
    assert got == want and len(want) > 1000


def test_infix_search_reads_the_rarest_runs(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the common part "), F.col("id").cast("string")).alias("text"))
    index = infix.build(rows, "doc_id", "text")
    asked = spark.createDataFrame([(1, "common part 1234"), (2, "not there")], "query_id int, pattern string")
    assert [(r.query_id, r.doc_id) for r in infix.search(index, asked).collect()] == [(1, 1234)]
    assert infix.postings_read(index, asked) < 200 < index.postings.count() / 100
    assert infix.search(infix.build(rows.limit(0), "doc_id", "text"), asked).count() == 0


def test_infix_index_has_a_row_for_each_run_of_a_block(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the common part "), F.col("id").cast("string")).alias("text"))
    index = infix.build(rows, "doc_id", "text")
    assert index.blocks.count() < 20_000 < 80_000 < index.postings.count() == index.sizes.agg(F.sum("n")).first()[0]
    assert index.blocks.filter("n <> size(ids)").count() == 0


def test_infix_blocks_hold_all_runs_of_all_texts(monkeypatch):
    rng = random.Random(4)
    wide = "".join(chr(c) for c in range(0x20, 0x22000) if not 0xD800 <= c < 0xE000)
    texts = ["".join(rng.choice("ab é😀中") for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))) for _ in range(300)]

    def inverted(texts, size):
        at = [*range(0, len(texts), size), len(texts)]
        batches = [pa.RecordBatch.from_arrays([pa.array(range(a, b)), pa.array(texts[a:b])], ["id", "text"]) for a, b in itertools.pairwise(at)]
        out = [r for b in infix._blocks(iter(batches)) for r in b.to_pylist()]
        assert all(r["n"] == len(r["ids"]) == len(set(r["ids"])) for r in out)
        return out

    def want(texts):
        return sorted({(x[k : k + n], i) for i, x in enumerate(texts) for n in (0, 1, 2, 3) for k in range(len(x) - n + 1)})

    whole = want(texts)
    for block, piece, size in ((4 << 20, 4 << 20, 300), (4 << 20, 4 << 20, 7), (900, 5, 300), (900, 1, 11), (1, 3, 300)):
        monkeypatch.setattr(infix, "BLOCK_BYTES", block)
        monkeypatch.setattr(infix, "PIECE", piece)
        assert sorted((r["run"], i) for r in inverted(texts, size) for i in r["ids"]) == whole
    monkeypatch.undo()
    many = ["a b"] * 5000 + [wide]  # three of so many characters and the row do not fit a key
    assert len(wide) ** 3 * len(many) > 1 << 63
    assert sorted((r["run"], i) for r in inverted(many, 5001) for i in r["ids"]) == want(many)


def test_infix_matches_equal_ilike(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("abAB _%\\\nÄΣσς") for _ in range(rng.randrange(14))) for _ in range(200)] + ["İstanbul", "", None, "100%", "a%", "ab%c"]
    patterns = ["a", "%a", "A%%", "ab", "abA", "aΣ", "Σ%", "İ", "i̇s", "", "%", "%%", "_", "__%a", "a_%_b", "a%a%a", "ab_", "_ab%b_", "\\\\", "a\\%", "\\_", "0%\\", "%\\", "b\\", "abab", "a%b", "ab%ab", None]
    patterns += ["".join(rng.choice("abΣ%_ ") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    asked = spark.createDataFrame(list(enumerate(patterns)), "query_id int, pattern string")
    want = sorted(tuple(r) for r in rows.crossJoin(asked).filter("text ILIKE concat('%', pattern, '%')").select("query_id", "doc_id", "text").collect())
    index = infix.build(rows, "doc_id", "text")
    assert sorted(tuple(r) for r in infix.search(index, asked).collect()) == want and len({q for q, _, _ in want}) > 60
    assert sorted(tuple(r) for r in infix.matches(index, asked).collect()) == [w[:2] for w in want]
    with pytest.raises(Exception, match="no escape"):
        infix.matches(index, spark.createDataFrame([(1, "a\\a")], "query_id int, pattern string")).collect()


def test_parameter_hits_show_three_fields(spark):
    docs = [(1, '{"material": {"name": "Copper"}, "plastic_parameters": {"flow_rule": "power"}}'), (2, '{"notes": "copper", "constitutive_model": {"framework": "CP"}}'), (3, '{"material": {"name": "Iron"}}'), (4, None)]
    got = retrieval.parameter_search(spark.createDataFrame(docs, "doi int, doc string"), "doc", "COPPER", retrieval.PARAMETER_FIELDS, "doi", 5)
    assert [tuple(r) for r in got.orderBy("doi").collect()] == [(1, "Copper", None, "power"), (2, None, "CP", None)]


# ---- report tables


def test_recall_columns_follow_the_data(spark):
    runs = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 2), ("q2", "a", 1), ("q2", "c", 3), ("q3", "a", 1)], "query_id string, doc_id string, rank int")
    qrels = spark.createDataFrame([("q1", "b"), ("q2", "c"), ("q3", "z"), ("q9", "a")], "query_id string, doc_id string")
    got = evalsuite.recall_table("m", runs, qrels, spark.createDataFrame([(2,), (3,), (2,)], "k int"))
    assert got.columns == ["method", "queries", "mrr", "recall@2", "recall@3"]
    assert tuple(got.first()) == ("m", 3, round((1 / 2 + 1 / 3) / 3, 9), round(1 / 3, 9), round(2 / 3, 9))
