"""Importance resampling towards a target: hashed n-gram features, their CRCs composed by algebra, and exact Gumbel top-k.

The CRC of a joined string follows from the CRCs of its parts: crc(a + b) is crc(a) moved on by the
length of b, xor crc(b), and moving on is a linear map over GF(2). Each word's CRC is computed once;
those of "a b" and "a b c" are composed from them, so no n-gram string is made.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textkit import Words, slices
from lodestrata.llm.work import short_batches, stored
from lodestrata.operators.numbering import numbered

BUCKETS, MOST_WORDS = 10_000, 3  # buckets of the features; words of the longest
SEED, LEAST_WORDS, PERCENT = 42, 20, 5
_PART = 1 << 19  # words whose features are made at a time
_SHORT = 32  # bytes of a word up to which CRCs are computed side by side

#: Bytes that stand in no word: all but digits, letters and what is not ASCII.
APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


def _as_table(columns: np.ndarray) -> np.ndarray:
    """A 32 x 32 matrix over GF(2), given by its columns, as one table of 256 results for each byte of a vector."""
    x = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for k in range(32):
        out[k // 8] ^= np.where(x >> (k % 8) & 1, columns[k], np.uint32(0)).astype(np.uint32)
    return out


def _times(table: np.ndarray, v: np.ndarray) -> np.ndarray:
    return table[0, v & 255] ^ table[1, v >> 8 & 255] ^ table[2, v >> 16 & 255] ^ table[3, v >> 24]


_CRC = _byte_table()


def _moves() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables that move a CRC on by 0 to 63 bytes, and by 64, 128, 256 and so on up to 2^40."""
    units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = _as_table(_CRC[units & 255] ^ (units >> 8))
    columns, few = units, []
    for _ in range(64):
        few.append(_as_table(columns))
        columns = _times(one, columns)
    many = []
    for _ in range(35):
        many.append(_as_table(columns))
        columns = _times(many[-1], columns)
    return np.stack(few), many


_FEW, _MANY = _moves()


def moved(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs moved on by ``n`` bytes each: what they add to the CRC of a string that goes on for ``n`` bytes."""
    low = n & 63
    out = _FEW[low, 0, crc & 255] ^ _FEW[low, 1, crc >> 8 & 255] ^ _FEW[low, 2, crc >> 16 & 255] ^ _FEW[low, 3, crc >> 24]
    high, k = n >> 6, 0
    while high.any():
        odd = np.flatnonzero(high & 1)
        out[odd] = _times(_MANY[k], out[odd])
        high, k = high >> 1, k + 1
    return out


def word_crcs(w: Words) -> np.ndarray:
    """The unsigned CRC-32 of each word's bytes."""
    size = w.end - w.start
    out = np.zeros(len(size), np.uint32)
    short = np.flatnonzero(size <= _SHORT)
    short = short[np.argsort(-size[short], kind="stable")]
    reach = np.searchsorted(-size[short], -np.arange(_SHORT + 1), side="left")  # how many of them are longer than k bytes
    crc = np.full(len(short), 0xFFFFFFFF, np.uint32)
    at = w.start[short]
    for k in range(_SHORT):
        n = reach[k]
        if not n:
            break
        crc[:n] = _CRC[(crc[:n] ^ w.buf[at[:n] + k]) & 255] ^ (crc[:n] >> 8)
    out[short] = ~crc
    for k in np.flatnonzero(size > _SHORT):
        out[k] = zlib.crc32(w.buf[w.start[k] : w.end[k]])
    return out


def features(w: Words, most: int = MOST_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """CRCs of all runs of 1 to ``most`` words joined by one space, with the row of each; so many words at a time."""
    space = np.full(1, zlib.crc32(b" "), np.uint32)
    for at in range(0, len(w.start), _PART):
        end = min(at + _PART, len(w.start))
        part = slice(at, min(end + most - 1, len(w.start)))
        cut = Words.__new__(Words)
        cut.buf, cut.start, cut.end = w.buf, w.start[part], w.end[part]
        row, size, own = w.row[part], cut.end - cut.start, word_crcs(cut)
        after = moved(np.repeat(space, len(own)), size) ^ own  # CRC of a space and the word
        run = own
        for n in range(1, most + 1):
            if n > 1:
                run = moved(run[:-1], size[n - 1 :] + 1) ^ after[n - 1 :]
            keep = np.flatnonzero(row[: len(run)] == row[n - 1 :])
            keep = keep[keep < end - at]
            yield run[keep], row[keep]


def _words(texts: DataFrame, keep: list) -> DataFrame:
    return texts.select(*keep, F.col("text").cast("string").alias("text"))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = MOST_WORDS) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket, summed within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in slices(whole):
                for crc, _ in features(Words(batch.column(0), apart=APART), most):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    made = _words(texts, []).mapInArrow(run, "bucket int, n long")
    return made.groupBy("bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = MOST_WORDS) -> DataFrame:
    """(bucket, gain): 1000 times the log of how much likelier a bucket's features are in ``target`` than in ``docs``.

    Both tables need a column ``text``; all of both is counted. One row a bucket, ``buckets`` in all,
    also where the tables are empty (gain 0).
    """
    spark = docs.sparkSession
    short_batches(spark)
    s, t = bucket_counts(docs, buckets, most).withColumnRenamed("n", "s"), bucket_counts(target, buckets, most).withColumnRenamed("n", "t")
    every = spark.range(0, buckets, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    both = stored(every.join(s, "bucket", "left").join(t, "bucket", "left").select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "buckets")
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = f"(t + 1D) * (all_s + {float(buckets)}D) / ((s + 1D) * (all_t + {float(buckets)}D))"
    return both.crossJoin(F.broadcast(sums)).select("bucket", F.expr(f"floor(1000 * ln({ratio}))").alias("gain"))  # one row


def weigh(docs: DataFrame, gains: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_features and weight, the sum of its features' gains.

    The gains, one number a bucket, are handed to the tasks.
    """
    short_batches(docs.sparkSession)
    rows = gains.toArrow()
    gain = np.zeros(rows.num_rows, np.int64)
    gain[rows.column("bucket").to_numpy()] = rows.column("gain").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                w = Words(batch.column(1), apart=APART)
                n, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                for crc, row in features(w, most):
                    if len(row):
                        # Rows ascend, so a row's features stand together.
                        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                        n[row[first]] += np.diff(np.append(first, len(row)))
                        weight[row[first]] += np.add.reduceat(gain[crc % np.uint32(len(gain))], first)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(w.first)), pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return _words(docs, [F.col("doc_id").cast("long").alias("doc_id")]).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, most: int = MOST_WORDS) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_features, weight, score and rank, null where the row is not drawn.

    Drawing the highest of weight plus Gumbel noise, 1000 times both, is sampling without
    replacement in proportion to exp(weight / 1000). The noise depends on the seed and the id only,
    so reruns agree; of equal scores the smaller id comes first, then any. Of rows with ``least`` words
    at least, ``percent`` of a hundred are drawn, rounded down. Null and empty texts have no features,
    weight 0, and are never drawn unless ``least`` is 0. Repeated rows each take part. A null id has
    the noise of an empty one and comes after others of its score. doc_id is cast to long; other columns take
    no part. An empty table gives an empty result.
    """
    noise = f"floor(-1000 * ln(-ln((cast(conv(substring(sha2(concat('{seed}:', coalesce(cast(doc_id AS string), '')), 256), 1, 8), 16, 10) AS double) + 0.5D) / 4294967296D)))"
    rows = weigh(docs, fit(docs, target, buckets, most), most).withColumn("score", F.col("weight") + F.expr(noise))
    rows = stored(rows.withColumn("_out", F.col("n_words") < least), "weights")
    drawn = rows.filter("not _out").count() * percent // 100
    placed = numbered(rows, [F.col("_out"), F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "_place")
    return placed.withColumn("rank", F.when(~F.col("_out") & (F.col("_place") <= drawn), F.col("_place")).cast("long")).drop("_out", "_place")
