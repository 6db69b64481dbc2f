"""Near-duplicates by one-permutation hashing with optimal densification and banded buckets.

Exact copies (equal shingle sets) collapse to one representative before any bucket is made. In a
bucket, candidates are star-shaped: each member against the smallest id. Links are confirmed on full
shingle sets. Where a bucket's members then still lie in different components, a second star is laid
around the smallest id outside the first component, and what is apart even then is joined exactly, by
prefixes of their rarest shingles; so stars miss no link that their bucket holds, and a bucket
of copies costs one star.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.components import components, linked
from lodestrata.llm.textkit import Words, grams, mix, slices
from lodestrata.llm.work import short_batches, stored

#: 40 bands of 8 rows: a pair of similarity 0.8 shares a bucket with probability 0.9994, one of 0.9 with 1 - 1e-10, one of 0.4 with 0.026.
BANDS, ROWS = 40, 8


def sketches(h: np.ndarray, first: np.ndarray, bins: int, seed: int = 1) -> np.ndarray:
    """One-permutation sketches of the rows' hash sets (sorted within each row), densified.

    A hash falls into one bin and the bin keeps its least. An empty bin copies the first full bin
    of its own fixed random sequence of bins, the same for every row, so equal sets keep equal
    sketches and the copies stay pairwise independent. Rows without hashes give zeros.
    """
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    at = row * bins + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    lead = np.ones(len(h), bool)
    lead[1:] = at[1:] != at[:-1]
    out, full = np.zeros(n * bins, np.uint64), np.zeros(n * bins, bool)
    out[at[lead]], full[at[lead]] = h[lead], True
    given = full.reshape(n, bins)
    hole = np.flatnonzero(~full & np.repeat(np.diff(first) > 0, bins))
    step = 0
    while len(hole):
        r, b = hole // bins, hole % bins
        to = (mix((b * 0x1000193 + step * 0x9E3779B1 + seed * 0x85EBCA6B).astype(np.uint64)) % np.uint64(bins)).astype(np.int64)
        hit = given[r, to]
        out[hole[hit]] = out[r[hit] * bins + to[hit]]
        hole, step = hole[~hit], step + 1
    return out.reshape(n, bins)


def shingle_sets(batch: pa.RecordBatch, n: int, text: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes of each row, ascending within the row, and the row offsets."""
    words = Words(batch.column(text))
    g, row = grams(words.hashes(), words.first, n, short=True)
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    if len(g):
        keep = np.ones(len(g), bool)
        keep[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        g, row = g[keep], row[keep]
    return g, np.searchsorted(row, np.arange(batch.num_rows + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (total[first[1:]] - total[first[:-1]]).astype(np.int64)


def _list(values: np.ndarray, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values.view(np.int64)))


def _marks(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: doc_id, n_shingles, a 128-bit fingerprint of the set, and the keys of its buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                g, first = shingle_sets(batch, shingle)
                n = len(first) - 1
                keys = np.zeros((n, BANDS), np.uint64)
                s = sketches(g, first, BANDS * ROWS).reshape(n, BANDS, ROWS)
                for r in range(ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + s[:, :, r])
                keys = mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
                size = np.diff(first)
                some = size > 0
                bands = _list(keys[some].ravel(), np.concatenate(([0], np.cumsum(some * BANDS))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size, pa.int64()), pa.array(_sums(g, first)), pa.array(_sums(mix(g + np.uint64(0x51ED270B)), first)), bands],
                    ["doc_id", "n_shingles", "fp1", "fp2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, shingles) of the wanted representatives (rep, fp1), recomputed from their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                g, first = shingle_sets(batch, shingle)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sums(g, first)), _list(g, first)], ["rep", "fp1", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text")).join(wanted.select("rep").distinct(), "rep", "left_semi")
    made = texts.mapInArrow(run, "rep long, fp1 long, shingles array<long>")
    return made.join(wanted.distinct(), ["rep", "fp1"], "left_semi").dropDuplicates(["rep", "fp1"]).select("rep", "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= 80 * union of the full sets. Sets travel once per pair, to the hub's side."""
    with_b = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    both = with_b.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * common >= 80 * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _prefix_pairs(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of ``rest`` (rep, n, component) in different components that can reach the similarity, by prefixes.

    Ordered from the rarest shingle on, two sets of similarity 0.8 have a common one among the first
    n - ceil(8/9 n) + 1 of the smaller and the first n - ceil(0.8 n) + 1 of the larger, and what
    comes after the first such one must suffice for the overlap. So the words of a passage that many
    texts hold are passed over wherever a text has enough of its own. Shingles seen in one component only are dropped by a
    pre-aggregated count before the join, so a large group of copies makes no pairs with itself.

    Whether sizes and positions leave a pair enough overlap is settled between the cells (size,
    position) of a shingle, of which short texts have few however many they are. Rows meet only
    in pairs of cells that can reach the similarity, so texts that share a passage but
    have too much of their own are never laid side by side.
    """
    shingles = rest.join(sets, "rep").select("rep", "n", "component", F.explode("shingles").alias("g"))
    often = shingles.groupBy("g").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = shingles.join(often, "g", "left").groupBy("rep", "n", "component").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "g"))).alias("x"))
    prefix = ordered.select("rep", "n", "component", F.posexplode(F.slice("x", F.lit(1), (F.col("n") - F.expr("(4 * n + 4) div 5") + 1).cast("int"))).alias("at", "x"))
    short = F.col("at") <= F.col("n") - F.expr("(8 * n + 8) div 9")
    prefix = stored(prefix.filter("x.df > 1").select("rep", "n", "component", "at", short.alias("short"), F.col("x.g").alias("g")), "prefixes")
    mixed = stored(prefix.groupBy("g").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("short").alias("short")).filter("lo <> hi and short").select("g"), "mixed")
    own = stored(prefix.join(mixed, "g", "left_semi"), "own")
    cells = own.groupBy("g", "n", "at", "short").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    large = cells.select("g", F.col("n").alias("na"), F.col("at").alias("ia"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
    small = cells.filter("short").select("g", F.col("n").alias("nb"), F.col("at").alias("ib"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    able = "nb <= na and 5 * nb >= 4 * na and 9 * least(na - ia, nb - ib) >= 4 * (na + nb) and least(la, lb) <> greatest(ha, hb)"
    fits = stored(large.join(small, "g").filter(able).select("g", "na", "ia", "nb", "ib"), "cells")
    a = own.select("g", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("at").alias("ia"))
    b = own.filter("short").select("g", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("at").alias("ib"))
    met = a.join(fits, ["g", "na", "ia"]).join(b, ["g", "nb", "ib"])
    return met.filter("ca <> cb and (nb < na or b < a)").select("a", "b").distinct()


def _apart(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, rep, n, component, x) of buckets whose members lie in several components; x is the least of these."""
    named = shared.filter("members > 2").join(labels, shared["rep"] == labels["node"], "left").select("bucket", "rep", "n", F.coalesce("component", "rep").alias("component"))
    several = named.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket", "x")
    return named.join(several, "bucket")


def _second_stars(apart: DataFrame) -> DataFrame:
    """Pairs (a, b) of the smallest id outside a bucket's first component and each member of other components than its own."""
    hubs = stored(apart.filter("component <> x").groupBy("bucket").agg(F.min(F.struct("rep", "n", "component")).alias("hub")), "hubs")
    met = apart.join(hubs, "bucket").filter("component <> hub.component and 5 * least(n, hub.n) >= 4 * greatest(n, hub.n)")
    return met.select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """Per row of docs (doc_id, text): n_shingles, component_id and kept.

    Words are lower-cased (A-Z) runs of bytes other than space and 0x09-0x0D; a text with fewer than
    ``shingle`` words has its whole sequence as one shingle. A text without words, and a null text,
    has an empty set, links with nothing and is kept. Repeated rows are exact copies of one another
    and carry the same ids. A null doc_id takes part in its class but is never a component's id,
    unless its class has no other. An empty table gives an empty result.
    """
    short_batches(docs.sparkSession)
    rows = stored(_marks(docs, shingle), "marks")
    classes = stored(
        rows.filter("n_shingles > 0").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    members = classes.filter("rep is not null").select("rep", "fp1", "n", F.explode("bands").alias("bucket"))
    buckets = stored(members.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("members")).filter("members > 1"), "buckets")
    shared = stored(members.join(buckets, "bucket"), "shared")

    hubs = shared.filter("rep = hub").select("bucket", F.col("n").alias("hub_n"))
    stars = shared.filter("rep <> hub").join(hubs, "bucket").filter("5 * least(n, hub_n) >= 4 * greatest(n, hub_n)")
    tested = stored(stars.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    sets = stored(_sets(docs, shared.select("rep", "fp1").distinct(), shingle), "sets")
    links = stored(_confirmed(tested, sets), "links")
    labels = components(links)

    # Buckets of three or more whose members are still apart: a second star, then an exact join of those members.
    apart = stored(_apart(shared, labels), "apart")
    if not apart.isEmpty():
        more = stored(_confirmed(stored(_second_stars(apart).join(tested, ["a", "b"], "left_anti"), "pairs"), sets), "links")
        if not more.isEmpty():
            labels = linked(labels, more)
            apart = stored(_apart(shared, labels), "apart")
        rest = stored(apart.select("rep", "n", "component").distinct(), "rest")
        more = stored(_confirmed(stored(_prefix_pairs(rest, sets), "pairs"), sets), "links")
        if not more.isEmpty():
            labels = linked(labels, more)

    of_class = classes.join(labels, classes["rep"] == labels["node"], "left").select("fp1", "fp2", F.coalesce("component", "rep").alias("component_id"))
    of_class = stored(of_class, "components")
    some = rows.filter("n_shingles > 0").drop("bands").join(of_class, ["fp1", "fp2"]).select("doc_id", "n_shingles", "component_id")
    none = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; rows that are alike in id and text stay once.

    Rows with a null id stay. Rows that share an id stay if any of them does.
    """
    found = stored(near_duplicates(docs, shingle), "near")
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept").select("doc_id")
    out = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    if found.groupBy("doc_id", "component_id").count().filter("count > 1 and doc_id is not null").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])
