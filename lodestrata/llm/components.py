"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.work import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; long): the smallest node reachable.

    Each round is two aggregations and two joins over the links and at least halves the depth of
    what is not yet a star. A hub with a large share of all links is pre-aggregated before its
    shuffle, and the join back to it has exchanges on both sides, which adaptive execution splits.
    Self-links and repeated links change nothing; an empty table gives an empty result.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    for _ in range(most_rounds):
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
        large = both.join(low, both["u"] == low["w"]).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(low, large["u"] == low["w"])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("w"), F.col("m"))).filter("u <> v").distinct()
        edges = stored(small, "stars")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())


def linked(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component; each component a node too) after more links (a, b), whose ends may be new nodes.

    Only the components that the links touch are joined anew; without links nothing changes.
    """
    of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    ends = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    roots = stored(components(ends), "roots")
    old = labels.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    new = roots.join(labels.select("node"), "node", "left_anti").select("node", "component")
    return stored(old.union(new), "labels")
