"""Case-folded infix search through a stored inverted index of runs of one to three characters.

A pattern's literal parts give the runs that a matching text must hold. The rarest few of them are
looked up, their postings intersected by counting, and what is left is verified on the texts, so
results equal a scan's for any pattern. Rows that hold a frequent run are not read where a rarer one is there.
Where a pattern is a single run, but for percent signs, its postings are the result and no text is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.session import short_batches
from lodestrata.storage import stored

MOST_RUNS = 3  # runs of a pattern that are looked up
BLOCK_BYTES = 4 << 20  # bytes of the texts of a block, 64 more counted for each; a longer text is a block of its own
PIECE = 4 << 20  # characters of a long text that are gone through at once
LIST = 1_000  # patterns, about, that a text is verified for at once


@dataclass(frozen=True)
class InfixIndex:
    """``lowered`` (id, text); ``blocks`` (run, n, ids): for each block of rows and each run in it, the n ids of the rows that hold it; ``sizes`` (run, n)."""

    rows: DataFrame
    id_col: str
    lowered: DataFrame
    blocks: DataFrame
    sizes: DataFrame

    @property
    def postings(self) -> DataFrame:
        """(run, id)"""
        return self.blocks.select("run", F.explode("ids").alias("id"))


def _runs(text: Column, sizes: tuple[int, ...] = (1, 2, 3)) -> Column:
    """The distinct runs of these many characters of a lower-cased text."""
    def every(c: Column) -> Column:
        of = lambda n: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*[F.get(c, i + k) for k in range(n)]))
        return F.array_distinct(F.concat(*[F.when(F.size(c) >= n, of(n)).otherwise(F.array().cast("array<string>")) for n in sizes]))

    # The characters are bound to a variable: an expression within a lambda is evaluated for each element.
    return F.when(F.length(text) > 0, F.transform(F.array(F.split(text, "(?s)(?<=.)(?=.)")), every)[0]).otherwise(F.array().cast("array<string>"))


def _keys(chars: np.ndarray, base: int, row: np.ndarray, rows: int, n: int) -> np.ndarray:
    """The distinct keys (n characters, row) in their order; ``chars`` are numbers below ``base``, ``row`` has the row of each."""
    got = []
    for a in range(0, len(chars) - n + 1, PIECE):
        b = min(a + PIECE, len(chars) - n + 1)
        key = chars[a:b].astype(np.int64)
        for k in range(1, n):
            key *= base
            key += chars[a + k : b + k]
        key *= rows
        key += row[a:b]
        key = key[row[a:b] == row[a + n - 1 : b + n - 1]]
        key.sort()
        got.append(key[np.diff(key, prepend=-1) != 0])
    return got[0] if len(got) == 1 else np.unique(np.concatenate([np.zeros(0, np.int64), *got]))


def _inverted(ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """(run, n, ids) of a block of rows, the texts of which are large strings."""
    rows, names = len(ids), ["run", "n", "ids"]
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    at = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[ends - ends[0]]
    text = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    number = np.zeros(0x110000, np.int32)
    number[text] = 1
    letters = np.flatnonzero(number)
    base = len(letters)
    if rows > 1 and base**3 * rows >= 1 << 63:  # a key has 63 bits
        for half in (slice(0, rows // 2), slice(rows // 2, rows)):
            yield from _inverted(ids[half], texts[half])
        return
    number[letters] = np.arange(base)
    chars, row = number[text], np.repeat(np.arange(rows, dtype=np.int32), np.diff(at))
    yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([rows], pa.int64()), pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), ids)], names)
    for n in (1, 2, 3):
        code, held = np.divmod(_keys(chars, base, row, rows, n), rows)
        if not len(code):
            return
        first = np.flatnonzero(np.diff(code, prepend=-1))
        spelt = code[first]
        of = letters[np.stack([spelt // base**k % base for k in reversed(range(n))], axis=1)].astype("<u4").tobytes().decode("utf-32-le")
        bounds = np.append(first, len(code))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids.take(pa.array(held)))
        yield pa.RecordBatch.from_arrays([pa.array([of[k : k + n] for k in range(0, len(of), n)]), pa.array(np.diff(bounds), pa.int64()), lists], names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ids and texts as blocks, whatever their sizes are."""
    kept, size = [], 0
    for b in batches:
        texts = b.column(1).cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy() + 64)
        a = 0
        while a < b.num_rows:
            e = int(np.searchsorted(ends, BLOCK_BYTES - size + (ends[a - 1] if a else 0), "right"))
            if e > a or not kept:
                e = max(e, a + 1)
                kept.append((b.column(0)[a:e], texts[a:e]))
                size += int(ends[e - 1] - (ends[a - 1] if a else 0))
                a = e
            if a < b.num_rows or size >= BLOCK_BYTES:
                yield from _inverted(*(pa.concat_arrays(x) for x in zip(*kept)))
                kept, size = [], 0
    if kept:
        yield from _inverted(*(pa.concat_arrays(x) for x in zip(*kept)))


def build(rows: DataFrame, id_col: str, text_col: str) -> InfixIndex:
    """The index of all rows; ``id_col`` must tell them apart. Null texts match no pattern and are not in it.

    Every other row also has the empty run, for patterns of wildcards only. Each task inverts its rows a block at a time,
    so no posting is shuffled, and the rows of the index grow with the blocks and their different runs.
    """
    short_batches(rows.sparkSession)
    texts = rows.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.lower(text_col).alias("text"))
    lowered = stored(texts, "lowered")  # for the runs, and for searches
    blocks = stored(lowered.mapInArrow(_blocks, f"run string, n long, ids array<{texts.schema['id'].dataType.simpleString()}>"), "postings")
    return InfixIndex(rows, id_col, lowered, blocks, stored(blocks.groupBy("run").agg(F.sum("n").alias("n")), "run-sizes"))


def _literals(pattern: Column) -> Column:
    """The parts of a LIKE pattern between its wildcards; an escaped character starts a part of its own."""
    return F.filter(F.split(F.lower(pattern), r"[%_]|\\"), lambda x: x != "")


def pattern_runs(patterns: DataFrame) -> DataFrame:
    """(query_id, run): the runs that a text must hold, from the longest that each part of the pattern has; the empty one where it has no part."""
    parts = _literals(F.col("pattern"))
    of_part = lambda p: F.when(F.length(p) >= 3, _runs(p, (3,))).when(F.length(p) == 2, F.array(p)).otherwise(F.array(p))
    runs = F.flatten(F.transform(parts, of_part))
    return patterns.filter("pattern IS NOT NULL").select("query_id", F.explode(F.when(F.size(parts) > 0, F.array_distinct(runs)).otherwise(F.array(F.lit("")))).alias("run"))


def chosen_runs(index: InfixIndex, patterns: DataFrame) -> DataFrame:
    """(query_id, run, n): the rarest runs of each pattern, none where the index lacks one of them."""
    known = pattern_runs(patterns).join(index.sizes, "run", "left")
    by = Window.partitionBy("query_id")
    d = known.withColumn("_all", F.min(F.col("n").isNotNull()).over(by)).filter("_all").drop("_all")
    return d.withColumn("_k", F.row_number().over(by.orderBy("n", "run"))).filter(F.col("_k") <= MOST_RUNS).drop("_k")


def _read(patterns: DataFrame) -> DataFrame:
    """(query_id, pattern, decided): what is not null. A run decides alone where a pattern is up to three characters, or none, and percent signs."""
    parts = _literals(F.col("pattern"))
    short = (F.size(parts) <= 1) & (F.length(F.array_join(parts, "")) <= 3)
    decided = short & ~F.contains("pattern", F.lit("_")) & ~F.contains("pattern", F.lit("\\"))
    return stored(patterns.filter("pattern IS NOT NULL").select("query_id", "pattern", decided.alias("decided")), "patterns")


def _looked_up(index: InfixIndex, asked: DataFrame) -> DataFrame:
    """The columns of ``asked`` but its run, with each id that holds the run."""
    return index.blocks.select("run", "ids").join(asked, "run").select(*[c for c in asked.columns if c != "run"], F.explode("ids").alias("id"))


@lru_cache(4096)
def _segments(pattern: str) -> tuple:
    """What must follow each other in a text for LIKE of the pattern and a last ``%``: strings, and regular expressions where any character stands in one."""
    found, literal, regex, single = [], "", "", False
    for escaped, wild, plain in re.findall(r"\\(.)|([%_])|([^\\%_]+)", pattern + "%", re.S):
        if escaped and escaped not in "%_\\":
            raise ValueError(f"no escape: {pattern!r}")
        if wild == "%":
            found.append(re.compile(regex, re.S) if single else literal)
            literal, regex, single = "", "", False
        else:
            literal, regex, single = literal + escaped + plain, regex + (re.escape(escaped + plain) or "."), single or wild == "_"
    return tuple(found + ([re.compile(regex + r"\Z", re.S)] if regex else []))  # the last ``%`` is an escaped one


def _occurs(pattern: str, text: str) -> bool:
    at = 0
    for x in _segments(pattern):
        if isinstance(x, str):
            at = text.find(x, at) + len(x)
            if at < len(x):
                return False
        elif m := x.search(text, at):
            at = m.end()
        else:
            return False
    return True


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query_id, id) of those patterns in the list beside a text that occur in it. A text is decoded once for all of them."""
    for b in batches:
        asked = b.column(2)
        ends, flat = asked.offsets.to_pylist(), asked.flatten()
        queries, patterns = flat.flatten()
        patterns, hit, row = patterns.to_pylist(), [], []
        for k, text in enumerate(b.column(1).to_pylist()):
            met = [j for j in range(ends[k] - ends[0], ends[k + 1] - ends[0]) if _occurs(patterns[j], text)]
            hit += met
            row += [k] * len(met)
        yield pa.RecordBatch.from_arrays([queries.take(pa.array(hit, pa.int64())), b.column(0).take(pa.array(row, pa.int64()))], ["query_id", "id"])


def matches(index: InfixIndex, patterns: DataFrame) -> DataFrame:
    """(query_id, id): what ``search`` finds, without the rows. Texts are read for those patterns only that no run decides."""
    read = _read(patterns)
    sure = _looked_up(index, stored(pattern_runs(read.filter("decided")), "decided"))
    others = read.filter("NOT decided").select("query_id", F.lower("pattern").alias("pattern"))
    asked = stored(chosen_runs(index, others).select("query_id", "run", F.count("*").over(Window.partitionBy("query_id")).alias("_wanted")), "asked")
    met = _looked_up(index, asked).groupBy("query_id", "id").agg(F.count("*").alias("_n"), F.first("_wanted").alias("_wanted")).filter("_n = _wanted").select("query_id", "id")
    lists = F.pmod(F.xxhash64("query_id"), F.lit(others.count() // LIST + 1))
    per_text = stored(met.join(others, "query_id").groupBy("id", lists.alias("_list")).agg(F.collect_list(F.struct("query_id", "pattern")).alias("asked")), "met").drop("_list")
    kinds = [met.schema[c].dataType.simpleString() for c in ("query_id", "id")]
    found = index.lowered.join(per_text, "id").select("id", "text", "asked").mapInArrow(_verified, "query_id {}, id {}".format(*kinds))
    return sure.unionAll(found)


def search(index: InfixIndex, patterns: DataFrame) -> DataFrame:
    """The rows that each pattern (query_id, pattern) occurs in, as ``rows ILIKE '%pattern%'``, with query_id.

    ``%`` and ``_`` in a pattern are wildcards. A null pattern matches nothing.
    """
    met = matches(index, patterns).withColumnRenamed("query_id", "_query_id")
    hits = met.join(index.rows, met["id"] == index.rows[index.id_col])
    return hits.select(met["_query_id"].alias("query_id"), *[index.rows[c] for c in index.rows.columns])


def postings_read(index: InfixIndex, patterns: DataFrame) -> int:
    """How many postings a search of these patterns reads."""
    return chosen_runs(index, patterns).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
