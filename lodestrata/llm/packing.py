"""Best-fit packing by exact-complement hashing.

Documents become token pieces of at most ``seq_len``; the packing is planned on the histogram of
piece lengths, which has ``seq_len`` entries however large the corpus is, and carried out by one
join of each piece's (length, rank) with the plan's rank intervals.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.work import short_batches, stored

#: Pieces of one length that one task ranks at most, about.
RANK_CHUNK = 100_000
#: Pre-token pattern of the byte-level vocabulary (a fixed value of that public tokenizer).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(tokenizer_json: bytes, added: bool = False):
    """An encoder with the vocabulary and merge order of a byte-level BPE file.

    With ``added``, texts are split at the file's added tokens, which get their own ids, as its
    library does by default; else strings of such tokens are ordinary text.

    The file's own library makes the same ids at a quarter of the speed, which the packing tests compare.
    """
    import tiktoken

    file, letters = json.loads(tokenizer_json), _byte_letters()
    model, special = file["model"], {t["content"]: t["id"] for t in file["added_tokens"]}
    ranks = {bytes(letters[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
    return tiktoken.Encoding("bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens=special if added else {})


def token_pieces(docs: DataFrame, tokenizer: str | None = None, seq_len: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, added: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32 (and the ids as little-endian bytes).

    Null texts count as empty and give the end id alone. Repeated rows are documents of their own.
    Only documents above ``seq_len`` ids are cut; the first piece takes the odd length. ``added``:
    see encoder().
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, 50,257 entries
    id_type = docs.schema[id_col].dataType
    schema = f"{id_col} {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary.value, added), np.array([end_id], np.uint32)
        for batch in batches:
            ids_in = batch.column(0)
            out: list[list] = [[], [], [], [], [], []]
            for k, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                ids = np.concatenate((enc.encode_to_numpy(text, allowed_special="all").astype(np.uint32), end)) if text else end
                n, at, piece = len(ids), 0, 0
                while at < n:
                    stop = at + ((n - at) if n - at <= seq_len else (n % seq_len or seq_len) if piece == 0 else seq_len)
                    own = ids[at:stop].astype("<u4").tobytes()
                    for col, v in zip(out, (k, piece, at, stop - at, zlib.crc32(own), own), strict=True):
                        col.append(v)
                    at, piece = stop, piece + 1
            cols = [ids_in.take(pa.array(out[0], pa.int32())), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5])]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(out[5], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    short_batches(docs.sparkSession)
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


class SumIndex:
    """Index of the sums of one, two and three available lengths, kept up with their counts.

    For each sum it holds the entry with the longest first part. Counts only fall, so an entry that
    is spent gives way to the next one and none is looked at twice. ``held`` lengths are out of reach
    of a look-up; where they block an entry, the ones after it are tried without moving it.
    """

    def __init__(self, counts: np.ndarray):
        self.c, self.top = counts, len(counts) - 1
        self.pairs, self.triples = list(range(self.top + 1)), list(range(self.top + 1))

    def single(self, total: int, held: dict[int, int]) -> tuple[int, ...] | None:
        return (total,) if self.c[total] > held.get(total, 0) else None

    def _pair_at(self, hi: int, lo: int, held: dict[int, int]) -> bool:
        return self.c[hi] > held.get(hi, 0) + (hi == lo) and self.c[lo] > held.get(lo, 0)

    def pair(self, total: int, held: dict[int, int]) -> tuple[int, ...] | None:
        hi = min(self.pairs[total], total - 1)
        while 2 * hi >= total and not self._pair_at(hi, total - hi, {}):
            hi -= 1
        self.pairs[total] = hi
        while 2 * hi >= total:
            if self._pair_at(hi, total - hi, held):
                return hi, total - hi
            hi -= 1
        return None

    def triple(self, total: int, held: dict[int, int]) -> tuple[int, ...] | None:
        hi = min(self.triples[total], total - 2)
        while 3 * hi >= total and not (self.c[hi] and self.pair(total - hi, {})):
            hi -= 1
        self.triples[total] = hi
        while 3 * hi >= total:
            if self.c[hi] > held.get(hi, 0) and (two := self.pair(total - hi, held | {hi: held.get(hi, 0) + 1})):
                return hi, *two
            hi -= 1
        return None


def exact_fills(c: np.ndarray, seq_len: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Takes patterns that fill a sequence exactly from the counts: each length, longest first, with what fills its gap as one length, a sum of two or of three (``depth``). Each use takes the most that the counts allow."""
    index, used = SumIndex(c), []
    for parts, find in enumerate((index.single, index.pair, index.triple)[:depth], 1):
        for length in range(seq_len, 0, -1):
            gap = seq_len - length
            while c[length] > 0:
                found = () if gap == 0 else find(gap, {length: 1}) if gap >= parts else None
                if found is None:
                    break
                pattern = (length, *found)
                need = np.bincount(pattern, minlength=seq_len + 1)
                at = np.flatnonzero(need)
                n = int((c[at] // need[at]).min())
                c[at] -= n * need[at]
                used.append((pattern, n))
    return used


def best_fit(counts: np.ndarray, seq_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: every piece goes where the least room that suffices is; equal pieces and equal sequences are handled together."""
    bins: dict[int, dict[tuple[int, ...], int]] = {}

    def put(gap: int, pattern: tuple[int, ...], m: int) -> None:
        if m:
            own = bins.setdefault(gap, {})
            own[pattern] = own.get(pattern, 0) + m

    for length in range(seq_len, 0, -1):
        n = int(counts[length])
        while n:
            gap = min((g for g, own in bins.items() if g >= length and own), default=seq_len)
            # A sequence that takes a piece has the least room from then on, so it takes as many as fit.
            each = gap // length
            if gap == seq_len:
                pattern, m = (), n // each + 1
            else:
                pattern, m = bins[gap].popitem()
            full = min(m, n // each)
            odd = min(n - full * each, each) if m > full else 0
            put(gap - each * length, pattern + (length,) * each, full)
            put(gap - odd * length, pattern + (length,) * odd, int(odd > 0))
            if gap < seq_len:
                put(gap, pattern, m - full - int(odd > 0))
            n -= full * each + odd
    return [(p, m) for own in bins.values() for p, m in own.items()]


def plan(counts: dict[int, int], seq_len: int = 1024) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used, from the counts of the lengths.

    Combinations that fill a gap exactly are consumed first: single complements, then pairs, then
    triples; what has none goes by best fit. Short pieces spent on exact fills can be missed by the
    rest, so the depth that gives the fewest sequences counts, the deepest of equals; depth 0 is best
    fit alone, which the plan so never exceeds.
    """
    best: list[tuple[tuple[int, ...], int]] | None = None
    for depth in (3, 2, 1, 0):
        c = np.zeros(seq_len + 1, np.int64)
        for length, n in counts.items():
            c[length] = n
        got = exact_fills(c, seq_len, depth)
        got += best_fit(c, seq_len)
        if best is None or sum(n for _, n in got) < sum(n for _, n in best):
            best = got
    return best


def pack(pieces: DataFrame, seq_len: int = 1024, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Adds sequence_id and offset to stored pieces with a column ``length`` in 1..seq_len.

    Ranks within a length are made in chunks of about RANK_CHUNK pieces, as many as the histogram
    asks for, so that a length with a third of all rows is ranked by many tasks. The plan that is
    broadcast has at most one row per pattern and length in it, whatever the input. An empty input gives
    an empty result.
    """
    spark = pieces.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most seq_len rows
    rows, base, nth = [], 0, {}
    for pattern, n in plan(counts, seq_len):
        at = 0
        for length, same in groupby(sorted(pattern, reverse=True)):
            k = len(list(same))
            rows.append((length, nth.get(length, 0), n * k, n, base, at))
            nth[length] = nth.get(length, 0) + n * k
            at += length * k
        base += n
    slots = F.broadcast(spark.createDataFrame(rows, "length long, low long, span long, uses long, base long, at long"))
    chunks = F.broadcast(spark.createDataFrame([(k, 1 + n // RANK_CHUNK) for k, n in counts.items()], "length long, chunks long"))

    keyed = pieces.join(chunks, "length").withColumn("chunk", F.pmod(F.xxhash64(*order), F.col("chunks"))).drop("chunks")
    sizes = keyed.groupBy("length", "chunk").agg(F.count("*").alias("m"))
    before = sizes.withColumn("before", F.sum("m").over(Window.partitionBy("length").orderBy("chunk")) - F.col("m")).drop("m")
    others = [c for c in pieces.columns if c not in order and c != "length"]
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("length", "chunk").orderBy(*order, *others)))
    ranked = ranked.join(before, ["length", "chunk"]).withColumn("rank", F.col("before") + F.col("rank") - 1)
    nth_in = F.col("rank") - F.col("low")
    placed = ranked.join(slots, "length").filter((nth_in >= 0) & (nth_in < F.col("span")))
    # Equal lengths of a pattern stand side by side: the first uses of it take the first place in each, the next ones the second.
    return placed.select(*pieces.columns, (F.col("base") + nth_in % F.col("uses")).alias("sequence_id"), (F.col("at") + F.expr("(rank - low) div uses") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, seq_len: int = 1024, end_id: int = 2, with_ids: bool = False, added: bool = False) -> DataFrame:
    """Tokenises, cuts and packs documents (columns doc_id, text); pieces are stored once between the two passes."""
    return pack(stored(token_pieces(docs, tokenizer, seq_len, end_id, with_ids=with_ids, added=added), "pieces"), seq_len)
