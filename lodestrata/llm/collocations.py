"""Phrase collocations: suffix arrays over word ids by shard, their LCP intervals as n-gram counts, merged by key.

Longer phrases are looked for only where shorter ones are frequent. Which those are is known
to the tasks as a filter of bounded size, which may let too much pass but never drops a phrase, so
counts are exact however full it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.textkit import Words, factors, grams, mix
from lodestrata.llm.work import short_batches, stored

MOST_WORDS, LEAST, FIRST = 5, 100, 2_000  # words of a phrase; its occurrences; phrases given by language
PERCENT = 100  # a phrase goes if a longer one that holds it has so many of a hundred of its occurrences
SHARD = 1 << 19  # words of a suffix array
FILTER_BITS = 26  # bits of a filter at most, as a power of two

_CUT = np.zeros(256, bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _CUT.copy()
_APART[[0x20, 0x09]] = True


class Shard:
    """Words of several texts as ids: ``key`` (word and language), ``rest`` (words to the end of the piece), and ``own`` (suffixes of the shard itself; words after these are there to be looked at)."""

    def __init__(self, words: pa.StringArray, ids: np.ndarray, lang: np.ndarray, ends: np.ndarray, own: int):
        self.words, self.ids, self.lang, self.own = words, ids, lang, own
        self.key = ids.astype(np.int64) * (int(lang.max(initial=0)) + 1) + lang
        stop = np.flatnonzero(ends)
        self.rest = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(len(ids)) + 1

    def hashes(self, langs: np.ndarray, n: int) -> np.ndarray:
        """Hash of the n-gram that starts at each word; without meaning where it leaves the piece."""
        h = np.append(Words(self.words, lower=False).hashes()[self.ids], np.zeros(n, np.uint64))
        total = np.zeros(len(self.ids), np.uint64)
        for k, m in enumerate(factors(n)):
            total += h[k : k + len(total)] * m
        return mix(mix(total) ^ langs[self.lang])

    def within(self, keep: np.ndarray, joined: np.ndarray, least: int) -> Shard:
        """The shard without words that are not to ``keep``, cut after those that are not ``joined`` to the next one, and without pieces of fewer than ``least`` words."""
        ends = (self.rest == 1) | ~joined
        ends[:-1] |= ~keep[1:]
        at = np.flatnonzero(keep)
        size = np.diff(np.flatnonzero(ends[at]), prepend=-1)
        at = at[np.repeat(size >= least, size)]
        return Shard(self.words, self.ids[at], self.lang[at], ends[at], int(np.searchsorted(at, self.own)))

    def suffixes(self, least: int, most: int) -> np.ndarray:
        """The shard's suffixes of ``least`` words or more, ordered by their first ``most`` words, by prefix doubling."""
        rank, width = np.unique(self.key, return_inverse=True)[1].astype(np.int64) + 1, 1
        while width < most:
            after = np.zeros(len(rank), np.int64)
            after[: max(len(rank) - width, 0)] = rank[width:]
            both = rank * (len(rank) + 2) + np.where(self.rest > width, after, 0)
            width *= 2
            if width >= most:
                at = np.flatnonzero(self.rest[: self.own] >= least)
                return at[np.argsort(both[at])]
            order = np.argsort(both)
            rank = np.empty(len(both), np.int64)
            rank[order] = np.cumsum(np.concatenate(([True], both[order[1:]] != both[order[:-1]]))) if len(both) else 0
        at = np.flatnonzero(self.rest[: self.own] >= least)
        return at[np.argsort(rank[at])]

    def common(self, order: np.ndarray, most: int) -> np.ndarray:
        """Words that each suffix has in common with the one before it, up to ``most``; none for the first."""
        out = np.zeros(len(order), np.int64)
        a, b = order[:-1], order[1:]
        alive = np.arange(len(a))
        for k in range(most):
            alive = alive[(self.rest[a[alive]] > k) & (self.rest[b[alive]] > k)]
            alive = alive[self.key[a[alive] + k] == self.key[b[alive] + k]]
            out[alive + 1] += 1
        return out

    def intervals(self, order: np.ndarray, common: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First places of the shard's distinct n-grams and their counts, from runs of suffixes that share n words."""
        lead = np.flatnonzero(common < n)
        count = np.diff(np.append(lead, len(order)))
        at = order[lead]
        inside = self.rest[at] >= n
        return at[inside], count[inside]

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.ids[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]


def _spelled(w: Words) -> pa.DictionaryArray:
    """The words' bytes as a dictionary array."""
    size = w.end - w.start
    inside = ~_APART[w.buf]
    ends = np.concatenate(([0], np.cumsum(size)))
    kind = (pa.large_string(), np.int64) if ends[-1] > 2**31 - 1 else (pa.string(), np.int32)
    made = pa.Array.from_buffers(kind[0], len(size), [None, pa.py_buffer(ends.astype(kind[1])), pa.py_buffer(w.buf[inside])])
    return made.dictionary_encode()


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[Shard, list[str]]]:
    """Shards of at most ``most`` words from batches (lang, text), with the names of their languages."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= 8 * most:
            yield from _cut(pa.Table.from_batches(held).combine_chunks().to_batches(), most)
            held, size = [], 0
    if held:
        yield from _cut(pa.Table.from_batches(held).combine_chunks().to_batches(), most)


def _cut(batches: list[pa.RecordBatch], most: int) -> Iterator[tuple[Shard, list[str]]]:
    for batch in batches:
        w = Words(batch.column(1), apart=_APART)
        if not len(w.start):
            continue
        langs = batch.column(0).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False)[w.row]
        cuts = np.cumsum(_CUT[w.buf], dtype=np.int64)[w.start]
        ends = np.ones(len(w.start), bool)
        ends[:-1] = (w.row[1:] != w.row[:-1]) | (cuts[1:] != cuts[:-1])
        spelled = _spelled(w)
        ids = spelled.indices.to_numpy(zero_copy_only=False)
        for at in range(0, len(ids), most):
            own = min(most, len(ids) - at)
            part = slice(at, min(at + own + MOST_WORDS - 1, len(ids)))
            last = ends[part].copy()
            last[-1] = True
            yield Shard(spelled.dictionary, ids[part], lang[part], last, own), langs.dictionary.to_pylist()


def _lang_hashes(names: list[str]) -> np.ndarray:
    return mix(np.array([zlib.crc32(x.encode()) for x in names], np.uint64))


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - bits)).astype(np.int64), (mix(h) >> np.uint64(64 - bits)).astype(np.int64)


def _passes(held: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = (len(held) * 64 - 1).bit_length()
    out = np.ones(len(h), bool)
    for p in _places(h, bits):
        out &= held[p >> 6] >> (p & 63).astype(np.uint64) & np.uint64(1) == 1
    return out


def frequent_filter(frequent: DataFrame, n: int, most_bits: int = FILTER_BITS):
    """A Bloom filter of the n-word phrases of ``frequent`` (lang, phrase), broadcast: about 16 bits a phrase, and 2^``most_bits`` at most.

    The tasks send words of bits, which are joined by key; the driver takes 2^20 of these at most.
    """
    spark = frequent.sparkSession
    bits = min(most_bits, max(12, (16 * frequent.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            w = Words(batch.column(1), lower=False)
            g, row = grams(w.hashes(), w.first, n)
            h = mix(g ^ _lang_hashes(langs.dictionary.to_pylist())[langs.indices.to_numpy(zero_copy_only=False)[row]])
            for p in _places(h, bits):
                np.bitwise_or.at(held, p >> 6, np.uint64(1) << (p & 63).astype(np.uint64))
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some].view(np.int64))], ["at", "bits"])

    rows = frequent.select("lang", "phrase").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(1 << (bits - 6), np.uint64)
    held[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(held)


def phrase_counts(texts: DataFrame, lengths: tuple[int, ...], words=None, pairs=None, size: int = SHARD) -> DataFrame:
    """(lang, words, phrase, n): counts over all texts (lang, text) of the phrases of these lengths; of length 0, all words of a language.

    ``words`` and ``pairs`` are filters of the frequent phrases of one and two words. A phrase is left
    out only if it holds one that is not frequent.
    """
    low, high = max(1, min(lengths)), max(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, names in _shards(batches, size):
            langs, out = _lang_hashes(names), []
            if 0 in lengths:
                n = np.bincount(shard.lang[: shard.own], minlength=len(names))
                some = np.flatnonzero(n)
                out.append((some, pa.array([""] * len(some), pa.string()), n[some]))
            if words is not None:
                known = _passes(words.value, shard.hashes(langs, 1))
                shard = shard.within(known, np.ones(len(known), bool), low)
            if pairs is not None:
                shard = shard.within(np.ones(len(shard.ids), bool), _passes(pairs.value, shard.hashes(langs, 2)), low)
            order = shard.suffixes(low, high)
            common = shard.common(order, high)
            for k in lengths:
                if k:
                    at, count = shard.intervals(order, common, k)
                    out.append((shard.lang[at], shard.phrases(at, k), count))
            # Language and phrase are one key, so that rows are short; a phrase holds no line end.
            name = pa.array([f"{x}\n" for x in names], pa.string())
            for lang, phrase, count in out:
                key = pc.binary_join_element_wise(name.take(pa.array(lang)), phrase.cast(pa.string()), "")
                for a in range(0, len(count), 20_000):
                    yield pa.RecordBatch.from_arrays([key[a : a + 20_000], pa.array(count[a : a + 20_000], pa.int64())], ["key", "n"])

    made = texts.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\n", -1)
    words = F.when(phrase == "", 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1)
    return made.select(F.expr("left(key, length(key) - length(substring_index(key, '\n', -1)) - 1)").alias("lang"), words.cast("int").alias("words"), phrase.alias("phrase"), "n")


def frequent_phrases(docs: DataFrame, least: int = LEAST, size: int = SHARD, most_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Totals (lang, n) and all phrases of 1 to 5 words with ``least`` occurrences or more (lang, words, phrase, n), both stored.

    Three passes over the texts: words; pairs of frequent words; longer phrases within frequent pairs.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    enough = (F.col("n") >= least) | (F.col("words") == 0)
    one = stored(phrase_counts(texts, (0, 1), size=size).filter(enough), "words")
    words = frequent_filter(one.filter("words = 1"), 1, most_bits)
    two = stored(phrase_counts(texts, (2,), words, size=size).filter(enough), "pairs")
    more = stored(phrase_counts(texts, tuple(range(3, MOST_WORDS + 1)), words, frequent_filter(two, 2, most_bits), size).filter(enough), "phrases")
    return one.filter("words = 0").select("lang", "n"), one.filter("words > 0").union(two).union(more)


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, percent: int = PERCENT, size: int = SHARD, most_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's first phrases by score: lang, rank, phrase, a, l, r, n and score of its weakest cut.

    Words are runs of bytes other than space and tab within pieces of a text that end at . , ; : ! ?
    and line ends; A-Z are lower-cased. A null lang is ``und``; null and empty texts have no words.
    Repeated rows count each time. A phrase whose words stand in a longer candidate with ``percent`` of a
    hundred of its occurrences at least is left out. Scores are whole numbers by exact decimals.
    Other columns take no part; an empty table gives an empty result.
    """
    short_batches(docs.sparkSession)
    return scored(*frequent_phrases(docs, least, size, most_bits), first, percent)


def scored(totals: DataFrame, found: DataFrame, first: int = FIRST, percent: int = PERCENT) -> DataFrame:
    """The scores of ``collocations`` from totals (lang, n) and all frequent phrases of one word or more (lang, words, phrase, n)."""
    candidates = found.filter("words > 1").withColumn("w", F.split("phrase", " "))

    # Inner runs of longer candidates, each with the highest count of those that hold it.
    size, start = F.col("_size"), F.col("_start")
    inner = candidates.filter("words > 2").withColumn("_size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("_start", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1))).select("lang", F.array_join(F.slice("w", start, size), " ").alias("phrase"), F.col("n").alias("_longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    left = candidates.join(inner, ["lang", "phrase"], "left").filter(f"_longer IS NULL OR 100 * _longer < {percent} * n").drop("_longer")

    cut = F.col("k")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", F.array_join(F.slice("w", F.lit(1), cut), " ").alias("_l"), F.array_join(F.slice("w", cut + 1, F.col("words") - cut), " ").alias("_r"))
    part = found.select("lang", "phrase", "n")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("_l"), F.col("n").alias("l")), ["lang", "_l"]).join(part.select("lang", F.col("phrase").alias("_r"), F.col("n").alias("r")), ["lang", "_r"])
    cuts = cuts.join(totals, "lang")
    score = F.expr("cast(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) as decimal(38,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("x"))
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = weakest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
