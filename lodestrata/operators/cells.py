"""Exact nearest neighbours of many queries through a stored index of cells.

Unit vectors lie in the cell of their nearest centroid; a cell knows the widest angle of its members
to it. By the triangle inequality no member is nearer to a query than the query's angle to the centroid
less that radius, so cells whose bound is beyond the k-th best found are passed over, and nothing is lost.
Cells are cut into blocks of bounded size, so a cell of very many vectors is many rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import short_batches
from lodestrata.storage import stored

MOST_CELLS = 1024  # cells at most; their centroids and radii are what every task holds
SAMPLE_BYTES = 64 << 20  # of vectors from which the centroids are fitted, at most
BLOCK_BYTES = 2 << 20  # of vectors in a block, at most
CHUNK = 512  # queries that meet a block at a time, about
_SLACK = 1e-9  # for rounding in angles


@dataclass(frozen=True)
class CellIndex:
    """``blocks`` (cell, block, ids, vectors as 64-bit unit rows) and, by cell, centroid, radius, members and blocks."""

    blocks: DataFrame
    centroids: np.ndarray
    radius: np.ndarray
    members: np.ndarray
    n_blocks: np.ndarray
    id_type: str


def _unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of the vectors that have a length, and their places."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    size = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    full = np.flatnonzero(size == size.max(initial=0)) if len(size) and size.max() else np.zeros(0, int)
    if (size[size > 0] != size.max(initial=0)).any():
        raise ValueError("vectors of different lengths")
    m = flat.reshape(len(full), -1) if len(full) else np.zeros((0, 0))
    norm = np.linalg.norm(m, axis=1) if len(full) else np.zeros(0)
    ok = np.isfinite(norm) & (norm > 0)
    return m[ok] / norm[ok, None], full[ok]


def _spherical(m: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k unit centroids of the sample ``m`` in the sample's order, fewer where it has fewer rows."""
    c = m[np.linspace(0, len(m) - 1, min(k, len(m))).astype(int)]
    for _ in range(rounds):
        near = np.argmax(m @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, m)
        norm = np.linalg.norm(sums, axis=1)
        c = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], c)
    return c


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None) -> CellIndex:
    """The index of all vectors of a table: about the root of their number of cells, MOST_CELLS at most.

    Centroids come from a hash sample of bounded size; every vector is then indexed. Rows whose vector is
    null, empty or of length 0 are not. Repeated rows are indexed each.
    """
    spark = vectors.sparkSession
    short_batches(spark)  # a row may hold a block of vectors
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter("v IS NOT NULL AND size(v) > 0")
    kind = rows.schema["id"].dataType.simpleString()
    n, dim = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    cells = min(cells or int(np.sqrt(n or 0)) + 1, MOST_CELLS)
    most = max(cells, min(32 * cells, SAMPLE_BYTES // (8 * (dim or 1))))
    share = min(1.0, most / max(n, 1))
    picked = rows.filter(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy(F.xxhash64("v"), "id").limit(2 * most)
    m, _ = _unit(pa.chunked_array(picked.select("v").toArrow().column("v").chunks, pa.list_(pa.float64())).combine_chunks())
    centroids = _spherical(m, cells) if len(m) else np.zeros((0, dim or 1))
    shared = spark.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m, at = _unit(b.column(1))
            if len(at):
                dot = m @ shared.value.T
                cell = np.argmax(dot, axis=1)
                wide = np.arccos(np.clip(dot[np.arange(len(at)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(cell, pa.int32()), pa.array(wide), pa.array([x.tobytes() for x in m], pa.binary())], ["id", "cell", "wide", "v"])

    placed = stored(rows.mapInArrow(place, f"id {kind}, cell int, wide double, v binary"), "placed")
    by = placed.groupBy("cell").agg(F.max("wide").alias("radius"), F.count("*").alias("n")).toArrow().to_pylist()  # one row a cell
    radius, members = np.zeros(len(centroids)), np.zeros(len(centroids), np.int64)
    for r in by:
        radius[r["cell"]], members[r["cell"]] = r["radius"], r["n"]
    per = max(1, BLOCK_BYTES // (8 * (dim or 1)))
    n_blocks = -(-members // per)
    sizes = spark.createDataFrame([(k, int(x)) for k, x in enumerate(n_blocks)], "cell int, _blocks long")
    dealt = placed.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.col("_blocks")))  # one row a cell
    blocks = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("id", "v")).alias("x")).select("cell", "block", F.col("x.id").alias("ids"), F.col("x.v").alias("vectors"))
    return CellIndex(stored(blocks, "cells"), centroids, radius, members, n_blocks, kind)


def _visits(index: CellIndex, queries: DataFrame, k: int, digits: int, chunks: int, bounded: bool) -> DataFrame:
    """(query_id, chunk, cell, block, q): the blocks that each query visits.

    Without a bound these are the nearest cells that hold more than k vectors, k at least besides
    the query's own; with one (column ``least``, the k-th best score so far), all others that can hold a better
    one.
    """
    own = {"c": index.centroids, "r": index.radius, "n": index.members, "b": index.n_blocks}
    shared = queries.sparkSession.sparkContext.broadcast(own)
    kind = queries.schema["query_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, radius, members, n_blocks = (shared.value[x] for x in "crnb")
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                b = whole.slice(a, 1024)
                m, at = _unit(b.column(1))
                if not len(at) or not len(c):
                    continue
                angle = np.arccos(np.clip(m @ c.T, -1, 1))
                order = np.argsort(angle, axis=1, kind="stable")
                before = np.cumsum(members[order], axis=1) - members[order]
                first = np.zeros(angle.shape, bool)
                np.put_along_axis(first, order, before <= k, axis=1)
                if bounded:
                    best = b.column(2).to_numpy(zero_copy_only=False)[at]
                    reach = np.cos(np.clip(angle - radius[None, :] - _SLACK, 0, np.pi))
                    first = ~first & (reach >= np.where(np.isnan(best), -2, best)[:, None] - 2 * 10.0**-digits)
                q, cell = np.nonzero(first & (members > 0)[None, :])
                times = n_blocks[cell]
                q, cell = np.repeat(q, times), np.repeat(cell, times)
                block = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
                ids = b.column(0).take(pa.array(at[q]))
                chunk = b.column(b.num_columns - 1).take(pa.array(at[q]))
                raw = np.array([x.tobytes() for x in m], object)
                for e in range(0, len(q), 4096):
                    s = slice(e, e + 4096)
                    yield pa.RecordBatch.from_arrays([ids[s], chunk[s], pa.array(cell[s], pa.int32()), pa.array(block[s], pa.int64()), pa.array(raw[q[s]], pa.binary())], ["query_id", "chunk", "cell", "block", "q"])

    cols = ["query_id", F.col("query_vec").cast("array<double>").alias("query_vec"), *(["least"] if bounded else []), F.pmod(F.xxhash64("query_id"), F.lit(chunks)).alias("chunk")]
    return queries.select(*cols).mapInArrow(run, f"query_id {kind}, chunk long, cell int, block long, q binary")


def _scored(index: CellIndex, visits: DataFrame, k: int, digits: int) -> DataFrame:
    """(query_id, id, score): the k best of each visited block."""
    kind = visits.schema["query_id"].dataType.simpleString()
    groups = visits.groupBy("cell", "block", "chunk").agg(F.collect_list(F.struct("query_id", "q")).alias("x")).select("cell", "block", F.col("x.query_id").alias("query_ids"), F.col("x.q").alias("qs"))
    met = groups.join(index.blocks, ["cell", "block"]).select("query_ids", "qs", "ids", "vectors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                qid, ids = b.column(0)[r].values, b.column(2)[r].values
                q = np.frombuffer(b"".join(b.column(1)[r].values.to_pylist())).reshape(len(qid), -1)
                v = np.frombuffer(b"".join(b.column(3)[r].values.to_pylist())).reshape(len(ids), -1)
                names = pa.concat_arrays([qid, ids]).dictionary_encode().indices.to_numpy() if qid.type == ids.type else None
                rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
                for a in range(0, len(qid), CHUNK):
                    score = np.round(q[a : a + CHUNK] @ v.T, digits)
                    if names is not None:
                        score[names[a : min(a + CHUNK, len(qid)), None] == names[None, len(qid) :]] = -2
                    top = np.lexsort((np.broadcast_to(rank, score.shape), -score))[:, :k]
                    best = np.take_along_axis(score, top, 1)
                    row, col = np.nonzero(best > -2)
                    yield pa.RecordBatch.from_arrays([qid.take(pa.array(row + a)), ids.take(pa.array(top[row, col])), pa.array(best[row, col])], ["query_id", "id", "score"])

    return met.mapInArrow(run, f"query_id {kind}, id {index.id_type}, score double")


def search(index: CellIndex, queries: DataFrame, k: int, digits: int = 9, chunk: int = CHUNK) -> DataFrame:
    """(query_id, id, score, rank): the k nearest indexed vectors of each row of queries (query_id, query_vec), by cosine.

    A vector of the query's own id is no neighbour. Scores are rounded, ties go to the smaller id.
    Exact for any number of queries and vectors: each query visits its nearest cells, and then all
    that can still hold something better. Queries without a vector, or with one of length 0, have no
    neighbours; of rows that share an id and a vector one is answered.
    """
    short_batches(queries.sparkSession)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = lambda rows: rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    asked = stored(queries.select("query_id", "query_vec").filter("query_vec IS NOT NULL AND size(query_vec) > 0").distinct(), "queries")
    chunks = asked.count() // chunk + 1
    near = stored(best(_scored(index, _visits(index, asked, k, digits, chunks, False), k, digits)), "near")
    least = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    bound = asked.join(least, asked["query_id"].eqNullSafe(least["query_id"]), "left").select(asked["query_id"], "query_vec", "least")
    far = _scored(index, _visits(index, bound, k, digits, chunks, True), k, digits)
    return best(near.drop("rank").union(far))


def share_read(index: CellIndex, queries: DataFrame, found: DataFrame, k: int, digits: int = 9) -> float:
    """The share of all pairs of query and cell that ``search`` looks into, given its result."""
    asked = queries.select("query_id", "query_vec")
    least = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    bound = asked.join(least, "query_id", "left").select("query_id", "query_vec", "least")
    read = sum(_visits(index, d, k, digits, 1, b).select("query_id", "cell").distinct().count() for d, b in ((asked, False), (bound, True)))
    return read / max(1, asked.count() * int((index.members > 0).sum()))
