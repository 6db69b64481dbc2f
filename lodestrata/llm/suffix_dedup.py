"""Repeated passages by sparse suffix arrays.

Suffixes are kept where a 16-word gram is the least of 34 neighbouring ones, so every passage of 49
words holds one at the same place in each of its copies. Suffixes whose gram occurs once are
dropped. Where a gram stands at a few places, all pairs of them are compared left and right; where
it stands at more, the passages around it are grouped by hashes of their words. Exact copies of
whole texts take no part in either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.textkit import Words, grams, mix, slices
from lodestrata.llm.work import short_batches, stored

GRAM, NEAR = 16, 34  # words of a gram; grams of which the least is kept
FEW = 5  # places of a gram up to which all pairs of them are compared
CODE = 4  # bytes of a word's code in a stored context
TASK_ROWS = 100_000  # suffixes that one task compares, about


def least_of(g: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """For each run of ``size`` neighbours of a row in ``g`` (row offsets ``first``) the index of the least; the leftmost of equals."""
    if len(g) < size:
        return np.zeros(0, np.int64)
    low, at, width = g, np.arange(len(g)), 1
    while width < size:
        step = min(width, size - width)
        later = low[step:] < low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return at[row[: len(at)] == row[size - 1 :]]


def kept_positions(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Indices into ``g`` (grams of all rows, row offsets ``first``) that are the least of some window of NEAR grams; the leftmost of equals."""
    return np.unique(least_of(g, first, NEAR))


def _suffixes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, a digest of the text, its number of words and its kept suffixes (gram, word position)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                w = Words(batch.column(2))
                g, row = grams(w.hashes(), w.first, GRAM)
                own = np.searchsorted(row, np.arange(batch.num_rows + 1))
                at = kept_positions(g, own)
                off = np.searchsorted(at, own)
                place = at - own[row[at]] if len(at) else at
                cols = [
                    batch.column(0), batch.column(1), pa.array(np.diff(w.first), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(g[at].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(place, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "digest", "n_words", "grams", "places"])

    return _texts(docs).mapInArrow(run, "doc_id long, digest string, n_words long, grams array<long>, places array<int>")


_NO_ID = (1 << 63) - 1  # stands for a null id, after all others


def _ident(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(_ident(F.col("doc_id")).alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))


def _binary(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])


_PLACE = "doc_id long, digest string, gram long, place int, right binary, left binary, head long, tail long, windows array<long>"


def _surroundings(found: DataFrame, least: int) -> DataFrame:
    """What stands around each repeated gram (doc_id, digest, text, grams, places, many).

    Of grams at a few places: the word codes right and left. Of the others: the hashes of those
    windows of ``least`` words in which the gram is the least one, which is one gram for each
    window; ``place`` is then the first window's, ``head`` and ``tail`` are its hash and the last one's.
    """
    reach = least - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                w = Words(batch.column(2))
                h = w.hashes()
                code = np.concatenate((np.maximum(h >> np.uint64(64 - 8 * CODE), np.uint64(1)), np.zeros(1, np.uint64))).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 4 - CODE :]
                lists, places, many = batch.column(3), batch.column(4), batch.column(5)
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                gram, place = lists.flatten().to_numpy(zero_copy_only=False), places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                is_many = many.flatten().to_numpy(zero_copy_only=False).astype(bool)
                at, lo, hi = w.first[row] + place, w.first[row], w.first[row + 1]
                few = np.flatnonzero(~is_many)
                for cut in range(0, len(few), 20_000):
                    s = few[cut : cut + 20_000]
                    right = at[s, None] + GRAM + np.arange(reach)
                    left = at[s, None] - 1 - np.arange(reach)
                    right, left = np.where(right < hi[s, None], right, len(h)), np.where(left >= lo[s, None], left, len(h))
                    ids = pa.array(row[s], pa.int32())
                    cols = [batch.column(0).take(ids), batch.column(1).take(ids), pa.array(gram[s]), pa.array(place[s], pa.int32())]
                    cols += [_binary(code[x].reshape(len(ids), reach * CODE)) for x in (right, left)]
                    cols += [pa.nulls(len(ids), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(cols, _names(_PLACE))
                s = np.flatnonzero(is_many)
                if not len(s):
                    continue
                g, g_row = grams(h, w.first, GRAM)
                own = np.searchsorted(g_row, np.arange(batch.num_rows + 1))
                window, w_row = grams(h, w.first, least)
                w_own = np.searchsorted(w_row, np.arange(batch.num_rows + 1))
                chosen = least_of(g, own, reach + 1)  # one gram a window, in rising order
                lo, hi = (np.searchsorted(chosen, own[row[s]] + place[s], side) for side in ("left", "right"))
                s, lo, hi = (x[hi > lo] for x in (s, lo, hi))
                for cut in range(0, len(s), 20_000):
                    k, a, n = s[cut : cut + 20_000], lo[cut : cut + 20_000], (hi - lo)[cut : cut + 20_000]
                    off = np.concatenate(([0], np.cumsum(n)))
                    each = window[np.repeat(a - off[:-1], n) + np.arange(off[-1])].view(np.int64)
                    ids = pa.array(row[k], pa.int32())
                    cols = [batch.column(0).take(ids), batch.column(1).take(ids), pa.array(gram[k]), pa.array(a - w_own[row[k]], pa.int32())]
                    cols += [pa.nulls(len(ids), pa.binary())] * 2 + [pa.array(each[off[:-1]]), pa.array(each[off[1:] - 1])]
                    cols.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(each)))
                    yield pa.RecordBatch.from_arrays(cols, _names(_PLACE))

    return found.select("doc_id", "digest", "text", "grams", "places", "many").mapInArrow(run, _PLACE)


def _names(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split(", ")]


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that agree from the start, row by row; the code 0 stands for none."""
    a, b = a.reshape(len(a), -1, CODE), b.reshape(len(b), -1, CODE)
    differ = ~a.any(axis=2)
    for k in range(CODE):
        differ |= a[:, :, k] != b[:, :, k]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


_SPAN = "doc_id long, digest string, start int, end int, removed boolean, first_doc_id long"


def _compare(least: int):
    """Compares all pairs of places of each gram; a gram's places are neighbours in one partition, FEW at most.

    A pair that agrees in l words left of the gram and r words right of it shares the windows of
    ``least`` words with reach - r to l words left of it. A window with an earlier place is
    removed, one with later places only is a first one. All hold the gram, so either kind is one span.
    """
    reach = least - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if t is None:
            return
        t = t.combine_chunks()
        n = t.num_rows

        def wide(c: str) -> np.ndarray:
            col = pa.concat_arrays(t.column(c).chunks)  # of one width
            return np.frombuffer(col.buffers()[2], np.uint8)[: n * reach * CODE].reshape(n, -1)

        gram, doc, place, right, left = t.column("gram").to_numpy(), t.column("doc_id").to_numpy(), t.column("place").to_numpy().astype(np.int64), wide("right"), wide("left")
        digest = pc.rank(t.column("digest"), tiebreaker="dense").to_numpy()
        rank = np.empty(n, np.int64)
        rank[np.lexsort((digest, place, doc))] = np.arange(n)
        # By place and number of words left of the gram: whether that window has an earlier and a later place.
        earlier, later, first = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool), doc.copy()
        for d in range(1, FEW):
            pairs = np.flatnonzero(gram[:-d] == gram[d:])
            for cut in range(0, len(pairs), 4096):
                i = pairs[cut : cut + 4096]
                i, j = np.where(rank[i] < rank[i + d], i, i + d), np.where(rank[i] < rank[i + d], i + d, i)
                l, r = _same(left[i], left[j]), _same(right[i], right[j])
                ok = l + r >= reach
                i, j, l, r = i[ok], j[ok], l[ok, None], r[ok, None]
                own = (np.arange(reach + 1) <= l) & (np.arange(reach + 1) >= reach - r)
                # A place can stand in two pairs of one distance.
                np.logical_or.at(later, i, own)
                np.logical_or.at(earlier, j, own)
                np.minimum.at(first, j, doc[i])
        for gone, own in ((False, later & ~earlier), (True, earlier)):
            found = np.flatnonzero(own.any(axis=1))
            for cut in range(0, len(found), 10_000):
                me = found[cut : cut + 10_000]
                start = place[me] - (reach - own[me, ::-1].argmax(axis=1))
                end = place[me] + GRAM + reach - own[me].argmax(axis=1)
                cols = [pa.array(doc[me]), t.column("digest").take(pa.array(me)).combine_chunks(), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
                cols += [pa.array(np.full(len(me), gone)), pa.array(first[me] if gone else doc[me])]
                yield pa.RecordBatch.from_arrays(cols, _names(_SPAN))

    return run


def _grouped(around: DataFrame, least: int) -> DataFrame:
    """Spans of the places whose windows are known by their hashes; each window is linked to its first place.

    Places with the same windows are one class, of which only the first place's windows are grouped,
    so that a passage in very many texts counts once; the other places are removed as a whole.
    """
    key = ["head", "tail", "n"]  # the first and the last window hold all words of those between
    around = around.withColumn("n", F.size("windows"))
    classes = stored(around.groupBy(*key).agg(F.min(F.struct("doc_id", "place", "digest", "windows")).alias("r"), F.count("*").alias("copies")), "classes")
    windows = classes.select(*key, "copies", "r.doc_id", "r.place", "r.digest", F.posexplode("r.windows").alias("at", "window"))
    me = F.struct("doc_id", (F.col("place") + F.col("at")).alias("place"), "digest")
    firsts = stored(windows.groupBy("window").agg(F.min(me).alias("first"), F.sum("copies").alias("n_places")).filter("n_places > 1").drop("n_places"), "firsts")
    hits = windows.join(firsts, "window").withColumn("removed", me != F.col("first"))
    ends = [f(F.when(F.col("removed") == gone, F.col("at"))).alias(name) for gone, f, name in ((True, F.min, "lo"), (True, F.max, "hi"), (False, F.min, "own_lo"), (False, F.max, "own_hi"))]
    found = hits.groupBy(*key, F.col("doc_id").alias("rep_id"), F.col("place").alias("rep_place"), F.col("digest").alias("rep_digest")).agg(*ends, F.min("first.doc_id").alias("first_doc_id"))
    d = around.select("doc_id", "digest", "place", *key).join(stored(found, "found"), key)

    def span(lo, hi, removed, first):
        return F.struct((F.col("place") + lo).alias("start"), (F.col("place") + hi + least).alias("end"), F.lit(removed).alias("removed"), first.alias("first_doc_id"))

    own = F.array(span(F.col("lo"), F.col("hi"), True, F.col("first_doc_id")), span(F.col("own_lo"), F.col("own_hi"), False, F.col("doc_id")))
    copy = F.array(span(F.lit(0), F.col("n") - 1, True, F.col("first_doc_id")))
    is_rep = (F.col("doc_id") == F.col("rep_id")) & (F.col("place") == F.col("rep_place")) & (F.col("digest") == F.col("rep_digest"))
    spans = d.select("doc_id", "digest", F.explode(F.when(is_rep, F.filter(own, lambda x: x["start"].isNotNull())).otherwise(copy)).alias("x"))
    return spans.select("doc_id", "digest", "x.start", "x.end", "x.removed", "x.first_doc_id")


def repeated_spans(docs: DataFrame, least: int = 50) -> DataFrame:
    """Spans of words that occur at two places or more: doc_id, digest, start_word, end_word, n_words, removed, first_doc_id.

    Words are lower-cased (A-Z) runs of bytes other than space and 0x09-0x0D. ``removed`` is false
    for words of which this is the first place, by doc_id and position. A copy of a whole text of
    ``least`` words or more is one span. Null and short texts have no spans; repeated rows are one
    document. doc_id must be of an integer type; a null id comes after all others. ``digest`` is the
    text's md5, which tells apart rows that share an id. An empty table gives an empty result.
    """
    if least < GRAM + NEAR - 1:
        raise ValueError(f"passages of fewer than {GRAM + NEAR - 1} words may hold no kept gram")
    short_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = stored(_suffixes(docs), "suffixes")
    long_rows = rows.filter(F.col("n_words") >= least)
    firsts = stored(long_rows.groupBy("digest").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("copies")), "texts")
    reps = long_rows.join(firsts.select("digest", F.col("first_doc_id").alias("doc_id")), ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"])
    places = reps.select("doc_id", "digest", F.explode(F.arrays_zip("grams", "places")).alias("x")).select("doc_id", "digest", F.col("x.grams").alias("gram"), F.col("x.places").alias("place"))
    twice = stored(places.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram", (F.col("n") > FEW).alias("many")), "grams")
    found = places.join(twice, "gram").groupBy("doc_id", "digest").agg(F.collect_list(F.struct("gram", "place", "many")).alias("x"))
    found = found.select("doc_id", "digest", F.col("x.gram").alias("grams"), F.col("x.place").alias("places"), F.col("x.many").alias("many"))
    texts = _texts(docs).dropDuplicates(["doc_id", "digest"]).join(found, ["doc_id", "digest"])
    around = stored(_surroundings(texts, least), "places")
    few = around.filter("windows is null").select("doc_id", "digest", "gram", "place", "right", "left")
    spans = few.repartition(few.count() // TASK_ROWS + 1, "gram").sortWithinPartitions("gram").mapInArrow(_compare(least), _SPAN)
    spans = spans.union(_grouped(around.filter("windows is not null").select("doc_id", "digest", "place", "head", "tail", "windows"), least))
    whole = long_rows.select("doc_id", "digest", "n_words").distinct().join(firsts.filter("copies > 1"), "digest")
    whole = whole.select("doc_id", "digest", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), (F.col("doc_id") > F.col("first_doc_id")).alias("removed"), "first_doc_id")
    out = _merged(spans.union(whole))
    return out.withColumns({c: F.nullif(F.col(c), F.lit(_NO_ID)) for c in ("doc_id", "first_doc_id")})


def _merged(spans: DataFrame) -> DataFrame:
    """Unions of overlapping or adjoining spans of a document, removed ones and first ones apart."""
    by = Window.partitionBy("doc_id", "digest", "removed").orderBy("start", "end")
    d = spans.groupBy("doc_id", "digest", "removed", "start", "end").agg(F.min("first_doc_id").alias("first_doc_id"))
    d = d.withColumn("far", F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    d = d.withColumn("run", F.sum(F.when(F.col("start") > F.col("far"), 1).otherwise(0)).over(by))
    out = d.groupBy("doc_id", "digest", "removed", "run").agg(F.min("start").cast("long").alias("start_word"), F.max("end").cast("long").alias("end_word"), F.min("first_doc_id").alias("first_doc_id"))
    return out.select("doc_id", "digest", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "removed", "first_doc_id")


def without_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """``docs`` with the words of removed spans cut from the texts; all columns and rows stay, n_chars follows the text where present.

    What stands between the words that stay is kept as it is; a text that is wholly repeated becomes empty.
    """
    cuts = repeated_spans(docs, least).filter("removed").groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias("x"))
    cuts = cuts.select(_ident(F.col("doc_id")).alias("_id"), F.col("digest").alias("_digest"), F.col("x.start_word").alias("_starts"), F.col("x.end_word").alias("_ends"))
    # Rows travel as one struct, so no column of theirs can clash with a helper.
    d = docs.select(F.struct("*").alias("_row"), _ident(F.col("doc_id")).alias("_doc"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_md5"))
    d = d.join(cuts, (d["_doc"] == cuts["_id"]) & (d["_md5"] == cuts["_digest"]), "left")

    @F.pandas_udf("string")
    def cut(text, starts, ends):
        import pandas as pd

        out = []
        for t, ss, es in zip(text, starts, ends, strict=True):
            col = pa.array([t or ""])
            w, data, parts, at = Words(col, lower=False), (t or "").encode(), [], 0
            for a, b in zip(ss, es, strict=True):
                parts.append(data[at : w.start[a]])
                at = int(w.start[b]) if b < len(w.start) else int(w.end[b - 1])
            parts.append(data[at:])
            out.append(b"".join(parts).decode("utf-8"))
        return pd.Series(out)

    # Only texts with cuts go through Python; the two branches read the same join.
    row = F.col("_row")
    plain = d.filter("_starts is null").select(*[row.getField(c).alias(c) for c in docs.columns])
    done = d.filter("_starts is not null").withColumn("_text", cut(row.getField("text"), "_starts", "_ends"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return plain.unionByName(done.select(*[new.get(c, row.getField(c)).alias(c) for c in docs.columns]))
