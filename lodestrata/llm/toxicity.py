"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are all words of the examples; document frequencies are counted over all documents. A term's
weight also rises with its association with label 1 in the sample, and no term is left out, so
every text that shares a word with an example has neighbours. The examples stand in an inverted
index whose postings lie in blocks with their greatest weights; blocks that cannot hold a nearest
example are passed over without loss. Distance-weighted votes of the nearest examples are calibrated
on the sample, leaving out an example's own group of copies; the nearest examples are the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.minhash_dedup import shingle_sets
from lodestrata.llm.textkit import NOT_LETTER, Words, sample_by, slices
from lodestrata.llm.work import give_back, short_batches

SAMPLE = 1_500  # labelled examples of each label, about: the default bound of the classifier's sample
CHANCE = 3.0  # root of the log-likelihood ratio up to which a term's association with label 1 is taken as chance
NEAREST = 15
BLOCK = 32  # examples of a block
OFTEN = 16  # a word in one of so many examples or more is frequent
POSTINGS = 1_500_000  # postings that a batch of queries goes through at once, about
DRIVER_POSTINGS = 60_000  # the same on the driver, which searches the examples for each other


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def term_counts(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words by text: row (ascending), key and count."""
    w = Words(col, apart=NOT_LETTER)
    keys = w.hashes()
    order = np.lexsort((keys, w.row))
    keys, rows = keys[order], w.row[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return rows[at], keys[at], np.diff(np.concatenate((at, [len(keys)])))


def _examples(train: DataFrame) -> list[dict]:
    """The sample's rows with their words, counts and group; of texts that are equal, the one with the smallest id stands for all.

    A group is a text's least 4-word shingle hash, which copies and most near-copies share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                g, first = shingle_sets(batch, 4)
                group = [int(g[a].view(np.int64)) if b > a else None for a, b in zip(first, first[1:], strict=False)]
                rows, keys, tf = term_counts(batch.column(1))
                cut = np.searchsorted(rows, np.arange(batch.num_rows + 1))
                parts = list(zip(cut, cut[1:], strict=False))
                own = [pa.array([keys[a:b].astype("<u8").tobytes() for a, b in parts], pa.binary()), pa.array([tf[a:b].astype("<u4").tobytes() for a, b in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(group, pa.int64()), *own], ["doc_id", "label", "share", "group", "keys", "tf"])

    one = train.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("label").alias("label"), F.sum(1 / F.col("fraction")).alias("share"))
    out = one.select("doc_id", "text", "label", "share").mapInArrow(run, "doc_id long, label int, share double, group long, keys binary, tf binary").toArrow().to_pylist()
    return sorted(out, key=lambda r: r["doc_id"])


def association(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Root of the log-likelihood ratio (G squared) of terms that are more frequent under label 1; 0 for the others."""
    n, has = n_pos + n_neg, pos + neg

    def part(k, row, col):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-300) * n / np.maximum(row * col, 1e-300)), 0.0)

    g = 2 * (part(pos, has, n_pos) + part(neg, has, n_neg) + part(n_pos - pos, n - has, n_pos) + part(n_neg - neg, n - has, n_neg))
    return np.where(pos * n_neg > neg * n_pos, np.sqrt(np.maximum(g, 0)), 0.0)


def _document_frequencies(docs: DataFrame, terms) -> tuple[np.ndarray, int]:
    """In how many of all documents each term of the examples is, and their number; ``terms`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = terms.value
        got, n = np.zeros(len(voc), np.int64), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                _, at, _ = _known(batch.column(1), voc)
                got += np.bincount(at, minlength=len(voc))
                n += batch.num_rows
        some = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], some)), pa.int32()), pa.array(np.concatenate(([n], got[some])))], ["term", "n"])

    out, total = np.zeros(len(terms.value), np.int64), 0
    found = _texts(docs).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    total = int(n[term < 0].sum())
    out[term[term >= 0]] = n[term >= 0]
    return out, total


def _known(col: pa.Array, voc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, term indices and counts of the texts' words that the examples hold."""
    rows, keys, tf = term_counts(col)
    if not len(voc):
        return rows[:0], rows[:0], tf[:0]
    at = np.minimum(np.searchsorted(voc, keys), len(voc) - 1)
    hit = voc[at] == keys
    return rows[hit], at[hit], tf[hit]


def normalised(rows: np.ndarray, terms: np.ndarray, tf: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Weights (1 + log tf) * weight of the term, each row of norm 1."""
    w = (1 + np.log(tf)) * weight[terms]
    return w / np.sqrt(np.bincount(rows, w**2, minlength=n))[rows]


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices start[k], start[k] + 1, ... (size[k] of them) of all k, and the k of each."""
    of = np.repeat(np.arange(len(size)), size)
    return np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(len(of)), of


class BlockMaxIndex:
    """Inverted index over example vectors (CSR: row, term, weight) with exact top-k search.

    Postings of words that many examples hold are rows of a matrix; those of the others lie in
    blocks with their greatest weights. A block's bound is its greatest score over the matrix plus
    the greatest weights of its other words.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int):
        self.n, self.blocks = n, -(-n // BLOCK)
        df = np.bincount(term, minlength=terms)
        often = df * OFTEN >= max(n, 1)
        self.column = np.where(often, np.cumsum(often) - 1, -1)
        self.df = np.where(often, 0, df)
        dense = often[term]
        self.cells = (self.column[term[dense]], row[dense], weight[dense])
        self._matrix = None
        row, term, weight = row[~dense], term[~dense], weight[~dense]
        order = np.lexsort((row, term))
        self.doc, self.weight, term = row[order].astype(np.int32), weight[order], term[order]
        block = self.doc // BLOCK
        head = np.ones(len(term), bool)
        head[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.start = np.flatnonzero(head)
        self.size = np.diff(np.concatenate((self.start, [len(term)])))
        self.block = block[self.start]
        self.most = np.maximum.reduceat(self.weight, self.start) if len(self.start) else self.weight
        self.of_term = np.searchsorted(term[self.start], np.arange(terms + 1))

    def __getstate__(self):
        return self.__dict__ | {"_matrix": None}

    @property
    def matrix(self) -> np.ndarray:
        """Weights of the frequent words by example, made where it is used."""
        if self._matrix is None:
            self._matrix = np.zeros((int(self.column.max(initial=-1)) + 1, self.blocks * BLOCK))
            self._matrix[self.cells[0], self.cells[1]] = self.cells[2]
        return self._matrix

    def nearest(self, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, but: np.ndarray | None = None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For n queries (row, term, weight) the k nearest examples and their cosines, 0 for none; exact, ties by position.

        ``but``: a row of flags for each query of the examples that it must not find. ``most``: postings of a batch, about, in place of ``POSTINGS``.
        """
        near, cosine = np.zeros((n, k), np.int64), np.zeros((n, k))
        cost = np.cumsum(np.bincount(rows, self.df[terms], minlength=n) + 4 * self.n)
        cuts = np.searchsorted(rows, np.arange(n + 1))
        a = 0
        while a < n and self.n:
            b = max(a + 1, int(np.searchsorted(cost, (cost[a - 1] if a else 0) + (most or POSTINGS), side="right")))
            s = slice(cuts[a], cuts[b])
            near[a:b], cosine[a:b] = self._group(rows[s] - a, terms[s], weights[s], b - a, k, None if but is None else but[a:b])
            a = b
        return near, cosine

    def _group(self, rows, terms, weights, n, k, but):
        column = self.column[terms]
        often = column >= 0
        q = np.zeros((n, len(self.matrix)))
        q[rows[often], column[often]] = weights[often]
        score = q @ self.matrix
        bound = score.reshape(n, self.blocks, BLOCK).max(2)
        score = score[:, : self.n]
        terms, rows, weights = terms[~often], rows[~often], weights[~often]
        lists, of = _spread(self.of_term[terms], self.of_term[terms + 1] - self.of_term[terms])
        q, row = weights[of], rows[of]
        cell = row * self.blocks + self.block[lists]
        bound = bound + np.bincount(cell, q * self.most[lists], minlength=n * self.blocks).reshape(n, self.blocks)
        first = np.zeros((n, self.blocks), bool)
        best = np.argsort(-bound, axis=1, kind="stable")[:, : 3 + 2 * k // BLOCK]
        np.put_along_axis(first, best, True, 1)
        some = first.ravel()[cell]
        score = score + self._score(lists[some], q[some], row[some], n)
        if but is not None:
            score[but] = 0
        k_own = min(k, self.n)
        if self.n > k:
            # Scores so far are below the true ones, so the k-th greatest is a level that the k nearest reach.
            level = np.partition(score, -k, axis=1)[:, -k]
            more = ((bound >= level[:, None] * (1 - 1e-9)) & ~first).ravel()[cell]
            if more.any():
                score += self._score(lists[more], q[more], row[more], n)
                if but is not None:
                    score[but] = 0
        top = np.argsort(-score, axis=1, kind="stable")[:, :k_own]
        near, cosine = np.zeros((n, k), np.int64), np.zeros((n, k))
        near[:, :k_own], cosine[:, :k_own] = top, np.clip(np.take_along_axis(score, top, 1), 0, 1)
        return near, cosine

    def _score(self, lists, q, row, n):
        at, of = _spread(self.start[lists], self.size[lists])
        return np.bincount(row[of] * self.n + self.doc[at], q[of] * self.weight[at], minlength=n * self.n).reshape(n, self.n)


def votes(near: np.ndarray, cosine: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """By query, the share of label 1 among the nearest, weighted by nearness; NaN without any."""
    w = cosine / (1.05 - cosine)
    total = w.sum(1)
    return np.where(total > 0, (w * labels[near]).sum(1) / np.where(total > 0, total, 1), np.nan)


def own_votes(index: BlockMaxIndex, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, labels: np.ndarray, kin: np.ndarray) -> np.ndarray:
    """Votes of the examples (all in the index) for each other, those of an example's own group left out; the index gives up its matrix again."""
    out = votes(*index.nearest(rows, terms, weights, index.n, NEAREST, kin[:, None] == kin[None, :], DRIVER_POSTINGS), labels)
    index._matrix = None
    return out


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of the weighted non-decreasing fit, by pooling neighbours that fall."""
    order = np.argsort(x, kind="stable")
    at, first = np.unique(x[order], return_index=True)
    sums = list(zip(np.add.reduceat((y * w)[order], first), np.add.reduceat(w[order], first), strict=True))
    pools: list[list[float]] = []
    for k, (s, n) in enumerate(sums):
        pools.append([s, n, k, k])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            b = pools.pop()
            pools[-1] = [pools[-1][0] + b[0], pools[-1][1] + b[1], pools[-1][2], b[3]]
    value = np.concatenate([np.full(int(p[3] - p[2]) + 1, p[0] / p[1]) for p in pools])
    return at, value


def fit(docs: DataFrame, labels: DataFrame, learn: str, sample: int = SAMPLE) -> dict:
    """A model from the rows of labels (doc_id, toxic) where the SQL expression ``learn`` holds.

    Null labels teach nothing; a document with several labels has the highest, and so have equal
    texts. The sample is drawn by a hash of the id, about ``sample`` rows a label; its words are what
    the driver holds and what is broadcast. In the terms' association with a label, the texts of one
    group of near-copies count as one. doc_id must be of an integer type.
    """
    model = _fit(docs, labels, learn, sample)
    give_back()  # what was freed meanwhile is several times the model
    return model


def _fit(docs: DataFrame, labels: DataFrame, learn: str, sample: int) -> dict:
    spark = docs.sparkSession
    short_batches(spark)
    known = labels.filter(F.expr(learn) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("label"))
    chosen = sample_by(known, "label", sample, 2 * sample, "doc_id").select(F.col("doc_id").cast("long").alias("_id"), "label", "fraction")
    texts = _texts(docs)
    got = _examples(texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["_id"]).select("doc_id", "text", "label", "fraction"))
    y, share = np.array([r["label"] for r in got], float), np.array([r["share"] for r in got])
    prior = float((share * y).sum() / share.sum()) if len(got) else 0.0
    keys = [np.frombuffer(r["keys"], "<u8") for r in got]
    voc, term = np.unique(np.concatenate(keys or [np.zeros(0, np.uint64)]), return_inverse=True)
    row = np.repeat(np.arange(len(got)), [len(k) for k in keys])
    tf = np.concatenate([np.frombuffer(r["tf"], "<u4") for r in got] or [np.zeros(0, np.uint32)])
    _, group, members = np.unique([r["group"] if r["group"] is not None else -1 for r in got], return_inverse=True, return_counts=True) if got else (None, np.zeros(0, np.int64), np.ones(1))
    each = 1 / members[group]
    pos, neg = np.bincount(term, (each * y)[row], len(voc)), np.bincount(term, (each * (1 - y))[row], len(voc))
    rise = np.maximum(association(pos, neg, float((each * y).sum()), float((each * (1 - y)).sum())) - CHANCE, 0) if len(got) else np.zeros(0)
    df, total = _document_frequencies(docs, spark.sparkContext.broadcast(voc)) if len(voc) else (np.zeros(0), 0)
    weight = (np.log((1 + total) / (1 + df)) + 1) * (1 + rise)

    # Neighbours in the index share their heaviest word, which tightens the blocks' bounds.
    w = normalised(row, term, tf, weight, len(got))
    heaviest = np.full(len(got), -1)
    order = np.lexsort((term, w))
    heaviest[row[order]] = term[order]
    some = np.flatnonzero(heaviest >= 0)
    place = np.full(len(got), -1)
    place[some[np.lexsort((some, heaviest[some], -y[some]))]] = np.arange(len(some))
    by = np.argsort(place[some])
    own = {"labels": y[some][by], "ids": np.array([r["doc_id"] for r in got], np.int64)[some][by]}
    index = BlockMaxIndex(place[row], term, w, len(some), len(voc))
    model = {"terms": voc, "weight": weight, "index": index, "prior": prior, "none": prior, "knots": None} | own
    lone = heaviest < 0
    if lone.any():
        model["none"] = float((share * y)[lone].sum() / share[lone].sum())
    if len(some):
        kin = group[some][by]
        order = np.argsort(place[row], kind="stable")
        raw = own_votes(index, place[row][order], term[order], w[order], model["labels"], kin)
        ok = ~np.isnan(raw)
        if ok.any():
            model["knots"] = isotonic(raw[ok], model["labels"][ok], share[some][by][ok])
    return model


def scored(col: pa.Array, m: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of the texts, their nearest examples' positions and cosines (0 for none)."""
    n = len(col)
    rows, terms, tf = _known(col, m["terms"])
    near, cosine = m["index"].nearest(rows, terms, normalised(rows, terms, tf, m["weight"], n), n, NEAREST)
    raw = votes(near, cosine, m["labels"]) if len(m["labels"]) else np.full(n, np.nan)
    some = ~np.isnan(raw)
    out = np.full(n, m["none"])
    out[some] = np.interp(raw[some], *m["knots"]) if m["knots"] is not None else raw[some]
    return out, near, cosine


def _shared(docs: DataFrame, model: dict):
    out = docs.sparkSession.sparkContext.broadcast(model)
    give_back()  # the copies that the broadcast's file was written from
    return out


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, and the ids of the nearest examples, nearest first, with their cosines.

    A text without a word of the examples (an empty or null one too) has the share of label 1 among
    such texts of the sample, or among all where it has none, and no evidence. Every row is scored by
    itself; a null doc_id stays null.
    """
    shared = _shared(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                out, near, cosine = scored(batch.column(1), m)
                found = cosine > 0
                off = pa.array(np.concatenate(([0], np.cumsum(found.sum(1)))), pa.int32())
                ids = pa.ListArray.from_arrays(off, pa.array(m["ids"][near[found]] if len(m["ids"]) else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), ids, pa.ListArray.from_arrays(off, pa.array(cosine[found]))], ["doc_id", "score", "evidence", "cosines"])

    return _texts(docs).mapInArrow(run, "doc_id long, score double, evidence array<long>, cosines array<double>")


def without_toxic(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score below ``least`` or have no evidence, whatever the labels' base rate is; all columns pass through as they are."""
    shared, at = _shared(docs, model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                out, _, cosine = scored(batch.column(at), m)
                yield batch.filter(pa.array((out < least) | ~(cosine > 0).any(1)))

    return docs.mapInArrow(run, docs.schema)
