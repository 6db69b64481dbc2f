"""Vectorised word splitting and hashing over Arrow string columns.

Words are the maximal runs of bytes other than space and 0x09-0x0D. These are ASCII, so a split of
UTF-8 bytes equals the split of code points. Lower-casing is that of A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_SEGMENT = 1 << 20
_tables: dict[str, np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _tables or len(_tables["p"]) < n:
        n = max(n, _SEGMENT + 4096)
        for key, base in (("p", _P), ("i", _PINV)):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            _tables[key] = np.multiply.accumulate(t)
    return _tables["p"], _tables["i"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Zero-copy cuts of a batch of about ``most`` bytes of text; a longer text stands alone."""
    if not batch.num_rows:
        return
    _, offsets = raw(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (n + 1); nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    n = len(col)
    _, off, data = col.buffers()
    if off is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of all rows of a string column: ``row`` (of each word), ``start``/``end`` bytes, ``first`` (n + 1 word offsets by row)."""

    def __init__(self, col: pa.Array, lower: bool = True, apart: np.ndarray = IS_SPACE):
        buf, self.offsets = raw(col)
        self.buf = LOWER[buf] if lower else buf
        n = len(self.offsets) - 1
        word = ~apart[self.buf]
        edge = np.zeros(len(word) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], word[:-1])) if len(word) else word
        after = np.concatenate((word[1:], [False])) if len(word) else word
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offsets).astype(np.int64)
        self.row = np.repeat(np.arange(n), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes, equal wherever the word stands."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):
            base = self.start[at]
            stop = max(at + 1, int(np.searchsorted(self.end, base + _SEGMENT, side="right")))
            last = self.end[stop - 1]
            p, inv = _powers(int(last - base) + 1)
            sums = np.zeros(last - base + 1, np.uint64)
            np.cumsum((self.buf[base:last].astype(np.uint64) + np.uint64(1)) * p[: last - base], out=sums[1:])
            s, e = self.start[at:stop] - base, self.end[at:stop] - base
            out[at:stop] = (sums[e] - sums[s]) * inv[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            at = stop
        return mix(out)

    def text(self, k: int) -> str:
        return self.buf[self.start[k] : self.end[k]].tobytes().decode("utf-8", "replace")


def factors(n: int) -> np.ndarray:
    """Odd factors of the places of a run, unrelated to each other, so that runs of the same words in another order differ."""
    return mix(np.arange(1, n + 1)) | np.uint64(1)


def grams(h: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of each row, with the row of each.

    With ``short``, a row of 1 to n - 1 words yields its whole sequence as one.
    """
    mult = factors(n)
    counts = np.diff(first)
    full = max(len(h) - n + 1, 0)
    g = np.zeros(full, np.uint64)
    for i in range(n):
        g += h[i : i + full] * mult[i]
    g = mix(g)
    row = np.repeat(np.arange(len(counts)), counts)
    keep = row[:full] == row[n - 1 : n - 1 + full] if full else np.zeros(0, bool)
    g, gr = g[keep], row[:full][keep]
    if short:
        rows = np.flatnonzero((counts > 0) & (counts < n))
        if len(rows):
            extra = np.zeros(len(rows), np.uint64)
            for i in range(n - 1):
                has = counts[rows] > i
                extra[has] += h[first[rows[has]] + i] * mult[i]
            extra = mix(extra + counts[rows].astype(np.uint64))
            g, gr = np.concatenate((g, extra)), np.concatenate((gr, rows))
            order = np.argsort(gr, kind="stable")
            g, gr = g[order], gr[order]
    return g, gr


def sample_by(rows: DataFrame, group: str, most: int, total: int, *key: str) -> DataFrame:
    """A fixed hash sample of about ``most`` rows of each group and about ``total`` in all, one of each group at least, with column ``fraction``.

    Whether a row is in depends on its key and its group's count and least hash only, so reruns
    agree. The counts by group are one row per group.
    """
    place = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(1 << 40)) / float(1 << 40)
    counts = rows.groupBy(group).agg(F.count("*").alias("_n"), F.min(place).alias("_least"))
    sizes = counts.withColumn("_each", F.least(F.lit(float(most)), F.lit(float(total)) / F.greatest(F.count("*").over(Window.partitionBy()), F.lit(1))))
    sizes = sizes.select(F.col(group).alias("_g"), F.least(F.lit(1.0), F.col("_each") / F.col("_n")).alias("fraction"), "_least")
    return rows.join(F.broadcast(sizes), rows[group] == sizes["_g"]).filter((place < F.col("fraction")) | (place == F.col("_least"))).drop("_g", "_least")
