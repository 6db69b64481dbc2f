"""Queries of table maintenance: the customer table as old state, values from orders as new rows."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import functions as F

from lodestrata.operators import keyed, store
from lodestrata.plans.registry import ORACLES, query
from lodestrata.session import table
from lodestrata.sources import database
from lodestrata.storage import scratch

_NEW = """
    WITH n AS (SELECT k AS c_custkey, name AS c_name, bal AS c_acctbal FROM (
      SELECT o_custkey + 100 AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS name, o_totalprice AS bal, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
    o AS (SELECT c_custkey, c_name, c_acctbal FROM customer)
"""


def _state(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    o = table(spark, sf_dir, "orders")
    new = store.latest(o, ["o_custkey"], ["o_orderkey"]).select((F.col("o_custkey") + 100).alias("c_custkey"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END").alias("c_name"), F.col("o_totalprice").alias("c_acctbal"))
    return old, new


@query(f"{_NEW} SELECT c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal FROM o FULL JOIN n USING (c_custkey)")
def upsert_coalesce(spark, sf_dir):
    return store.upsert_coalesce(*_state(spark, sf_dir), ["c_custkey"])


@query(f"{_NEW} SELECT c_custkey, CASE WHEN n.c_acctbal IS NOT NULL THEN n.c_name ELSE o.c_name END AS c_name, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal FROM o FULL JOIN n USING (c_custkey)")
def upsert_mixed(spark, sf_dir):
    return store.upsert_coalesce(*_state(spark, sf_dir), ["c_custkey"], overwrite=("c_name",))


@query(f"{_NEW} SELECT * FROM n UNION ALL SELECT * FROM o ANTI JOIN n USING (c_custkey)")
def upsert_overwrite(spark, sf_dir):
    return store.upsert_overwrite(*_state(spark, sf_dir), ["c_custkey"])


@query(f"{_NEW} SELECT * FROM o UNION ALL SELECT * FROM n ANTI JOIN o USING (c_custkey)")
def insert_ignore(spark, sf_dir):
    old, new = _state(spark, sf_dir)
    return store.insert_ignore(old, new, ["c_custkey"], ["c_acctbal"])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 10 <> 0 UNION ALL SELECT o_custkey, o_orderkey, 0 FROM orders WHERE o_custkey % 10 = 0 AND o_orderkey % 2 = 0 UNION ALL "
       "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 10 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 10 = 0 AND o_orderkey % 2 = 0)")  # fmt: skip
def replace_by_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    new = o.filter("o_custkey % 10 = 0 AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0))
    return store.replace_by_key(o, new, ["o_custkey"])


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_custkey), c_name FROM customer")
def append_numbered(spark, sf_dir):
    new = table(spark, sf_dir, "customer").select(F.col("c_name").alias("s_name"), "c_custkey")
    return store.append_numbered(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), new, "s_suppkey", ["c_custkey"])


@query("SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN label + 100 ELSE label END::INT AS label FROM embeddings")
def update_by_id(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return store.update_column(e, e.filter("vec_id % 2 = 0").withColumn("label", F.col("label") + 100), "vec_id", "label")


@query("SELECT event_id, event_type, NULL::VARCHAR AS prompt_version, value * 2 AS time_total FROM events")
def evolve_schema(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("time_total", F.col("value") * 2)
    return store.evolve(e, {"event_id": "bigint", "event_type": "string", "prompt_version": "string", "time_total": "double"})


@query("SELECT count(*) AS orphans FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)")
def fk_orphans(spark, sf_dir):
    return store.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0"), "o_custkey", "c_custkey").agg(F.count("*").alias("orphans"))


@query("SELECT o_custkey AS record_id, o_orderkey AS symbol, label, doi FROM (SELECT o_custkey, o_orderkey, o_orderstatus AS label FROM orders) JOIN (SELECT DISTINCT o_custkey, 'F' AS label, '10.1/' || o_custkey AS doi FROM orders WHERE o_custkey % 2 = 0) USING (o_custkey, label)")
def reference_links(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    params = o.select(F.col("o_custkey").alias("record_id"), F.col("o_orderkey").alias("symbol"), F.col("o_orderstatus").alias("label"))
    refs = o.select(F.col("o_custkey").alias("record_id"), F.lit("").alias("reference_id"), F.lit("F").alias("label"), F.expr("CASE WHEN o_custkey % 2 = 0 THEN concat('10.1/', o_custkey) END").alias("doi"))
    return store.reference_links(params, refs)


@query("SELECT n_name AS name, NULL::BIGINT AS nation, n_nationkey::BIGINT AS key FROM nation UNION ALL SELECT r_name, r_regionkey::BIGINT, NULL FROM region")
def union_sorted_columns(spark, sf_dir):
    from lodestrata.sources.sinks import union_sorted

    a = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("key"))
    b = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("bigint").alias("nation"))
    return union_sorted([a, b])


def _customers(spark, old):
    t = keyed.KeyedTable(spark, scratch(spark, "keyed") + "/table", ["c_custkey"], buckets=16)
    t.create(old)
    return t


@query(ORACLES["upsert_coalesce"])
def keyed_upsert(spark, sf_dir):
    """The same upsert in two batches on a table in buckets of its key, of which each batch rewrites those it touches."""
    old, new = _state(spark, sf_dir)
    t = _customers(spark, old)
    t.upsert(new.filter("c_custkey % 50 = 7"))
    t.upsert(new)
    return t.read()


@query(ORACLES["replace_by_key"])
def keyed_replace(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    t = keyed.KeyedTable(spark, scratch(spark, "keyed") + "/table", ["o_custkey"], buckets=16, files=2)
    t.create(o)
    new = o.filter("o_custkey % 10 = 0 AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.lit(0.0))
    for _ in range(2):  # a second time changes nothing
        t.replace(new)
    return t.read()


_TYPES = {"c_custkey": "BIGINT", "c_name": "VARCHAR(200)", "c_acctbal": "DOUBLE"}


@query(ORACLES["upsert_mixed"])
def database_merge(spark, sf_dir):
    """The mixed upsert in a database: ranged read, staging table, one merge. Here an embedded database on the driver's disk, which rows reach and leave as files in the shared folder."""
    home = tempfile.mkdtemp(prefix="lodestrata-db-")
    atexit.register(shutil.rmtree, home, True)
    url, props = f"jdbc:derby:{home}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    with database.connection(spark, url, props) as c:
        database.execute(c, "CREATE TABLE customers (c_custkey BIGINT PRIMARY KEY, c_name VARCHAR(200), c_acctbal DOUBLE)")
    old, new = _state(spark, sf_dir)
    database.merge(old, url, "customers", ["c_custkey"], _TYPES, props, ignore=True, embedded=True)
    database.merge(new, url, "customers", ["c_custkey"], _TYPES, props, overwrite=("c_name",), embedded=True)
    return database.export_ranges(spark, url, "customers", "c_custkey", "c_custkey bigint, c_name string, c_acctbal double", props)
