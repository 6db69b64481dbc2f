"""Language identification by the nearest of several centroids per language.

Texts are vectors of hashed letter n-grams, weighted by TF-IDF and normalised. Document frequencies
are counted over all training texts. Each language's sample is clustered by spherical k-means; a
text goes to the language of its nearest centroid by cosine, and is marked as rejected where that
cosine is below what the centroid's own sample reaches.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textkit import sample_by, slices
from lodestrata.llm.work import short_batches

BITS = 12  # of a hashed n-gram
ORDERS = (1, 2, 3)
CENTROIDS = 4  # of a language
SAMPLE, TOTAL = 600, 4_000  # sampled training texts of a language and in all, about: the default bounds of the classifier's sample
REJECT = 0.005  # share of a centroid's sample that lies beyond its rejection distance
ROWS = 512  # texts of which the vectors are held at once
UNKNOWN = "und"
_kinds: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, which belong to a word but make none, 0 for others."""
    if not _kinds:
        _kinds.append(np.fromiter(("ML".find(unicodedata.category(chr(c))[0]) + 1 for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1))
    return _kinds[0]


def ngram_counts(texts: list[str], piece: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams by text, and the number of letters; runs of other characters are one space. Long texts are gone through in pieces, and what stands at a border counts once."""
    size = 1 << BITS
    counts, letters = np.zeros((len(texts), size), np.float32), np.zeros(len(texts), np.int64)
    group, at = [], 0
    # What the text that a piece cuts was left with: its row, its last characters, and whether the very last was a letter.
    held = {"row": -1, "tail": np.zeros(0, np.uint32), "letter": False}

    def flush(parts: list[tuple[int, str]]) -> None:
        c = np.frombuffer("".join(t for _, t in parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat([r for r, _ in parts], [len(t) for _, t in parts])
        part = np.repeat(np.arange(len(parts)), [len(t) for _, t in parts])
        kind = _kind_table()[c]
        letters[:] += np.bincount(row[kind == 2], minlength=len(texts))
        is_letter = kind > 0
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1] & (part[1:] == part[:-1])
        goes_on = parts[0][0] == held["row"]
        if goes_on and len(keep):
            keep[0] |= held["letter"]
        tail = held["tail"] if goes_on else held["tail"][:0]
        held["row"], held["letter"] = parts[-1][0], bool(len(is_letter) and is_letter[-1])
        c, row, part = np.where(is_letter, c, 32)[keep].astype(np.uint32), row[keep], part[keep]
        c, row, part = np.concatenate((tail, c)), np.concatenate((np.full(len(tail), parts[0][0]), row)), np.concatenate((np.zeros(len(tail), np.int64), part))
        held["tail"] = c[part == len(parts) - 1][1 - max(ORDERS) :]
        for n in ORDERS:
            if len(c) < n:
                continue
            m = len(c) - n + 1
            h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                h = (h ^ c[i : i + m]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            same = part[:m] == part[n - 1 :]
            same[: max(len(tail) - n + 1, 0)] = False  # counted with the piece before
            cell = row[:m][same] * size + (h[same] * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS)).astype(np.int64)
            counts.ravel()[:] += np.bincount(cell, minlength=counts.size).astype(np.float32)

    for r, text in enumerate(texts):
        text = f" {text.lower()} "
        for k in range(0, len(text), piece):
            own = text[k : k + piece]
            group.append((r, own))
            at += len(own)
            if at >= piece:
                flush(group)
                group, at = [], 0
    if group:
        flush(group)
    return counts, letters


def _batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text"):
        for k in range(0, part.num_rows, ROWS):
            yield part.slice(k, ROWS)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.sqrt((v**2).sum(1, keepdims=True))
    return v / np.where(norm > 0, norm, 1)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out starts (each the vector least like those before); centroids of norm 1."""
    k = min(k, len(v))
    mean = v.mean(0)
    chosen = [int(np.argmax(v @ mean))]
    near = v @ v[chosen[0]]
    for _ in range(k - 1):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[chosen[-1]])
    c = v[chosen]
    for _ in range(rounds):
        own = np.argmax(v @ c.T, 1)
        new = np.stack([v[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c = new / np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
    return c


def fit(train: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, total: int = TOTAL) -> dict:
    """A model from training rows (doc_id, text, lang): document frequencies of all of them, centroids of a bounded hash sample by language.

    The sample has about ``sample`` texts a language and ``total`` in all, and one of each language
    at least. Rows without a language or a letter teach nothing. With no rows, nothing is learned
    and every text is ``und``.
    """
    train = train.filter(F.col("lang").isNotNull() & F.col("text").cast("string").rlike(r"\p{L}")).select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    spark, size = train.sparkSession, 1 << BITS
    short_batches(spark)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(size, np.int64), 0
        for whole in batches:
            for batch in _batches(whole):
                counts, letters = ngram_counts(batch.column(0).to_pylist())
                df += (counts > 0).sum(0)
                n += int((letters > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size), pa.int32()), pa.array(np.concatenate(([n], df)))], ["gram", "n"])

    got = np.zeros(size + 1, np.int64)
    for gram, n in train.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect():  # a row for each hashed n-gram
        got[gram + 1] = n
    idf = (np.log((1 + got[0]) / (1 + got[1:])) + 1).astype(np.float32)
    shared = spark.sparkContext.broadcast(idf)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole):
                counts, letters = ngram_counts(batch.column(1).to_pylist())
                v = weigh(counts, shared.value).astype(np.float32)
                ok = np.flatnonzero(letters > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ok)), pa.array([v[i].tobytes() for i in ok], pa.binary())], ["lang", "v"])

    rows = sample_by(train, "lang", sample, total, "doc_id", "text").select("lang", "text").mapInArrow(encode, "lang string, v binary").collect()
    langs = sorted({r["lang"] for r in rows})
    c, own, least = [], [], []
    for lang in langs:
        v = np.stack([np.frombuffer(r["v"], np.float32) for r in sorted((r for r in rows if r["lang"] == lang), key=lambda r: bytes(r["v"]))])
        k = cluster(v, centroids)
        sim = v @ k.T
        best = sim.argmax(1)
        c.append(k)
        own += [lang] * len(k)
        least += [float(np.quantile(sim[best == j].max(1), REJECT)) if (best == j).any() else 0.0 for j in range(len(k))]
    return {"idf": idf, "centroids": np.concatenate(c) if c else np.zeros((0, size), np.float32), "langs": own, "least": np.array(least)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, rejected. ``und`` with score 0 for a null text and one without a letter; score is the nearest centroid's cosine, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in _batches(whole):
                counts, letters = ngram_counts(batch.column(1).to_pylist())
                lang, score, rejected = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
                ok = np.flatnonzero(letters > 0) if len(m["langs"]) else np.zeros(0, np.int64)
                if len(ok):
                    sim = weigh(counts[ok], m["idf"]) @ m["centroids"].T
                    best = sim.argmax(1)
                    lang[ok], score[ok] = np.array(m["langs"], object)[best], np.clip(sim.max(1), 0, 1)
                    rejected[ok] = score[ok] < m["least"][best]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
