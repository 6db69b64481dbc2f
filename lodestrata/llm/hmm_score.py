"""Language-model scores by a hidden Markov model over words.

The corpus's word counts are exact over all training documents. Counting works in blocks: each
block of texts sends its distinct words to the bucket of each word, the buckets add them up and send
the sums back, so no task holds the vocabulary and no word, however frequent, is a hot key: a block
sends a word once. Frequent words are symbols of the model; all others share the symbol of their
class (a hash of the word's end), under which a word has its smoothed share of the class. Latent states are trained by Baum-Welch, whose
expected counts are added up across partitions; scores are exact sequence likelihoods by the
scaled forward recursion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textkit import Words, mix, slices
from lodestrata.llm.work import short_batches, stored

STATES = 8
CLASSES = 256  # of words by their last bytes; the low byte of a word's key
SYMBOLS = 4096  # 0 is the end, 1 to CLASSES stand for the words of a class that are not frequent, the others for one frequent word each
ROUNDS = 6  # of Baum-Welch
WINDOW = 512  # tokens of a part; texts of more than two parts are trained on in parts, which changes no count
BUCKET_WORDS = 400_000  # block words that a bucket adds up at once, about
END = np.uint64(1)  # the hash that stands for the end of a text
ALPHA = 0.1


def word_keys(w: Words) -> np.ndarray:
    """A 64-bit key of each word: 56 bits of its hash, then 8 of a hash of its last three bytes."""
    end = np.zeros(len(w.start), np.uint64)
    for k in range(1, 4):
        at = w.end - k
        end = end * np.uint64(257) + np.where(at >= w.start, w.buf[np.maximum(at, 0)], 0).astype(np.uint64) if len(at) else end
    return w.hashes() >> np.uint64(8) << np.uint64(8) | mix(end) >> np.uint64(56)


def _blocks(docs: DataFrame, held: str) -> DataFrame:
    """Texts by block: the distinct words of a block with their counts in training texts, and its documents as indices of those words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text", 4_000_000):
                w = Words(batch.column(2))
                held_out = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                n = np.diff(w.first) + 1
                off = np.concatenate(([0], np.cumsum(n)))
                tokens = np.full(off[-1], END, np.uint64)
                tokens[np.arange(len(w.start)) + w.row] = word_keys(w)
                words, index = np.unique(tokens, return_inverse=True)
                train = np.repeat(~held_out, n)
                counts = np.bincount(index[train], minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{part}-{k}"]), pa.array([words.astype("<u8").tobytes()], pa.binary()), pa.array([counts.astype("<u4").tobytes()], pa.binary()), pa.array([len(words)], pa.int64()),
                        pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([held_out.tolist()], pa.list_(pa.bool_())), pa.array([n.tolist()], pa.list_(pa.int64())),
                        pa.array([index.astype("<u4").tobytes()], pa.binary()),
                    ],
                    ["block", "words", "counts", "n_words", "ids", "held", "sizes", "tokens"],
                )
                k += 1

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(held).alias("held"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.mapInArrow(run, "block string, words binary, counts binary, n_words long, ids array<long>, held array<boolean>, sizes array<long>, tokens binary")


def _bucketed(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """The words of each block by bucket; hashes are uniform, so ranges of them are even buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array([(i << 64) // n_buckets for i in range(1, n_buckets)], np.uint64)
        for batch in batches:
            for block, words, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                w, c = np.frombuffer(words.as_py(), "<u8"), np.frombuffer(counts.as_py(), "<u4")
                at = [0, *np.searchsorted(w, cuts), len(w)]
                rows = [(b, block.as_py(), w[x:y].tobytes(), c[x:y].tobytes()) for b, (x, y) in enumerate(zip(at, at[1:], strict=False)) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["bucket", "block", "words", "counts"])

    return blocks.select("block", "words", "counts").mapInArrow(run, "bucket int, block string, words binary, counts binary")


def _summed(bucketed: DataFrame, symbols: int) -> DataFrame:
    """Per bucket and block the corpus counts of the block's words; per bucket (block null) its totals and its most frequent words."""

    def run(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(x.as_py(), "<u8") for x in table.column("words")]
        counts = [np.frombuffer(x.as_py(), "<u4") for x in table.column("counts")]
        own, inverse = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(own)).astype(np.int64)
        at = np.cumsum([0, *map(len, words)])
        top = np.lexsort((own, -total))[:symbols]
        top = top[total[top] > 0]
        b = table.column("bucket")[0].as_py()
        kind = np.where(own == END, CLASSES, (own & np.uint64(CLASSES - 1)).astype(np.int64))
        by_class = [np.bincount(kind, x, CLASSES + 1).astype("<i8").tobytes() for x in (total, total > 0)]
        rows = [(b, k.as_py(), total[inverse[x:y]].astype("<i8").tobytes(), None, None, None) for k, x, y in zip(table.column("block"), at, at[1:], strict=False)]
        rows.append((b, None, total[top].astype("<i8").tobytes(), own[top].astype("<u8").tobytes(), *by_class))
        types = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["bucket", "block", "counts", "top", "n", "v"])

    return bucketed.groupBy("bucket").applyInArrow(run, "bucket int, block string, counts binary, top binary, n binary, v binary")


class Vocabulary:
    """Corpus totals and the symbols; of bounded size."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, by_class: np.ndarray):
        order = np.argsort(words)
        self.words, counts = words[order], counts[order]
        self.n, self.v = (int(x) for x in by_class.sum(1))
        by_class = by_class[:, :CLASSES]  # without the end, which is its own symbol
        kind = self.kinds(self.words)
        self.rare_n, self.rare_v = by_class[0] - np.bincount(kind, counts, CLASSES), by_class[1] - np.bincount(kind, minlength=CLASSES)

    @staticmethod
    def kinds(words: np.ndarray) -> np.ndarray:
        return (words & np.uint64(CLASSES - 1)).astype(np.int64)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        rest = np.where(words == END, 0, 1 + self.kinds(words))
        if not len(self.words):
            return rest.astype(np.uint16)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1 + CLASSES, rest).astype(np.uint16)

    def rare(self, words: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 share of each word in its class's symbol, all unseen words of a class being one."""
        kind = self.kinds(words)
        return np.log10((c + ALPHA) / (self.rare_n[kind] + ALPHA * (self.rare_v[kind] + 1)))


def _vocabulary(summed: DataFrame, symbols: int) -> Vocabulary:
    """From the totals of all buckets; each bucket's candidates are cut to what its rank can reach, and the driver gets ``symbols`` rows."""
    heads = summed.filter("block is null")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros((2, CLASSES + 1), np.int64)
        for b in batches:
            for k in (0, 1):
                for x in b.column(k):
                    got[k] += np.frombuffer(x.as_py(), "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES + 1), pa.int32()), pa.array(got[0]), pa.array(got[1])], ["kind", "n", "v"])

    by_class = np.zeros((2, CLASSES + 1), np.int64)
    for kind, n, v in heads.select("n", "v").mapInArrow(totals, "kind int, n long, v long").groupBy("kind").agg(F.sum("n"), F.sum("v")).collect():  # CLASSES + 1 rows
        by_class[:, kind] = n, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, counts in zip(b.column(0), b.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(words.as_py(), "<u8").view("<i8")), pa.array(np.frombuffer(counts.as_py(), "<i8"))], ["word", "n"])

    rows = heads.select("top", "counts").mapInArrow(run, "word long, n long").filter(F.col("word") != int(END)).orderBy(F.desc("n"), "word").limit(symbols - 1 - CLASSES).collect()
    return Vocabulary(np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64), by_class)


def _encoded(blocks: DataFrame, summed: DataFrame, vocabulary) -> DataFrame:
    """Documents of each block as symbols, with their base scores and the scores of words outside the symbols."""
    back = summed.filter("block is not null").groupBy("block").agg(F.collect_list(F.struct("bucket", "counts")).alias("sums"))
    both = blocks.select("block", "words", "ids", "held", "sizes", "tokens").join(back, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary.value
        for batch in batches:
            for words, ids, held, sizes, tokens, sums in zip(*(batch.column(i) for i in range(1, 7)), strict=True):
                words, index, sizes = np.frombuffer(words.as_py(), "<u8"), np.frombuffer(tokens.as_py(), "<u4"), np.array(sizes.as_py(), np.int64)
                c = np.concatenate([np.frombuffer(x["counts"], "<i8") for x in sorted(sums.as_py(), key=lambda x: x["bucket"])])
                base = np.log10((c + ALPHA) / (voc.n + ALPHA * (voc.v + 1)))
                symbol = voc.symbols(words)
                rare = np.where((symbol > 0) & (symbol <= CLASSES), voc.rare(words, c), 0.0)
                at = np.concatenate(([0], np.cumsum(sizes)))
                lists = [np.add.reduceat(x[index], at[:-1]) for x in (base, rare, (c > 0).astype(np.int64))]
                sym = symbol[index].astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [ids.values, held.values, pa.array(sizes), pa.array(lists[2]), pa.array(lists[0]), pa.array(lists[1]), pa.array([sym[x:y].tobytes() for x, y in zip(at, at[1:], strict=False)], pa.binary())],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "rare_score", "symbols"],
                )

    return both.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, rare_score double, symbols binary")


def initial(counts: np.ndarray, states: int) -> dict[str, np.ndarray]:
    """Start values: transitions that mostly stay, emissions by symbol counts tilted by a fixed random factor."""
    rng = np.random.default_rng(7)
    b = (counts + ALPHA) * rng.uniform(0.1, 1.9, (states, len(counts)))
    a = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return {"pi": np.full(states, 1 / states), "a": a / a.sum(1, keepdims=True), "b": b / b.sum(1, keepdims=True)}


def _padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences longest first, as a time-major matrix, and how many are open at each step."""
    size = np.array([len(s) for s in seqs])
    o = np.zeros((size[0], len(seqs)), np.int64)
    for k, s in enumerate(seqs):
        o[: len(s), k] = s
    return o, (size[None, :] > np.arange(size[0])[:, None]).sum(1)


def forward(model: dict, seqs: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence (longest first), scaled at each step; memory does not grow with the states passed."""
    o, open_ = _padded(seqs)
    bt, a, out = np.ascontiguousarray(model["b"].T), model["a"], np.zeros(len(seqs))
    one = np.ones(len(a))  # sums over the states are products with it, which are much faster than sums along a short axis
    alpha = model["pi"] * bt[o[0]]
    for t in range(len(o)):
        m = open_[t]
        if t:
            alpha = alpha[:m] @ a
            alpha *= bt[o[t, :m]]
        s = alpha @ one
        out[:m] += np.log10(s)
        alpha /= s[:, None]
    return out


def expected(model: dict, seqs: list[np.ndarray], xi: np.ndarray, pi: np.ndarray, emit: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> float:
    """Adds the expected counts of sequences (longest first) to xi, pi and emit (symbol by state); returns their log10 likelihood.

    A sequence may be a part of a longer one: ``before`` is its state distribution given all tokens
    before it (a row of zeros where it starts a text), ``after`` the likelihood of all tokens after
    it by state, up to a factor. The counts of all parts then add up to those of the whole.
    """
    o, open_ = _padded(seqs)
    n_t, n = o.shape
    bt, a = np.ascontiguousarray(model["b"].T), model["a"]
    before = np.zeros((n, len(a))) if before is None else before
    starts = ~before.any(axis=1)
    one = np.ones(len(a))
    # One row for each token, step by step: those of step t begin at first[t].
    first = np.concatenate(([0], np.cumsum(open_)))
    f = np.concatenate([o[t, : open_[t]] for t in range(n_t)])
    alphas, scales = np.empty((first[-1], len(a))), np.empty(first[-1])
    for t in range(n_t):
        m, x = open_[t], alphas[first[t] : first[t + 1]]
        np.take(bt, o[t, :m], axis=0, out=x, mode="clip")  # symbols are in range; without the check there is no copy
        x *= np.where(starts[:, None], model["pi"], before @ a) if t == 0 else alphas[first[t - 1] : first[t - 1] + m] @ a
        s = scales[first[t] : first[t + 1]]
        np.matmul(x, one, out=s)
        x /= s[:, None]
    beta = np.ones((n, len(a))) if after is None else after.copy()
    last = alphas[first[np.array([len(s) for s in seqs]) - 1] + np.arange(n)]
    beta /= ((last * beta) @ one)[:, None]
    w = np.empty_like(alphas)
    for t in range(n_t - 1, -1, -1):
        m, here = open_[t], slice(first[t], first[t + 1])
        g = np.multiply(alphas[here], beta[:m], out=w[here])
        g /= (g @ one)[:, None]
        y = bt[o[t, :m]]
        y *= beta[:m]
        y /= scales[here, None]
        if t:
            xi += (alphas[first[t - 1] : first[t - 1] + m].T @ y) * a
            np.matmul(y, a.T, out=beta[:m])
        else:
            xi += (before.T @ y) * a
            pi += g[starts].sum(0)
    for k in range(len(a)):
        emit[:, k] += np.bincount(f, w[:, k], minlength=len(emit))
    return float(np.log10(scales).sum())


def transfers(model: dict, seqs: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Of each sequence (longest first) the matrix that carries the state before it to the one at its end, up to a factor; one that starts a text is entered by the start distribution."""
    o, open_ = _padded(seqs)
    bt, a = np.ascontiguousarray(model["b"].T), model["a"]
    x = np.where(starts[:, None, None], np.eye(len(a)), a) * bt[o[0]][:, None, :]
    for t in range(1, len(o)):
        m = open_[t]
        x[:m] = (x[:m].reshape(-1, len(a)) @ a).reshape(m, len(a), len(a))  # one product of a tall matrix, not one for each sequence
        x[:m] *= bt[o[t, :m]][:, None, :]
        if t % 8 == 0 or t == len(o) - 1:
            x[:m] /= x[:m].max(axis=(1, 2), keepdims=True)
    return x


def parts_of(model: dict, seqs: list[np.ndarray], window: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Groups of parts, longest first, with the states before and the likelihoods after them.

    Texts of up to two windows are one part. In longer ones, which would keep a task busy step by
    step, the parts' transfer matrices are made side by side and chained, so the parts can be counted
    side by side as well, with the exact states at their borders.
    """
    k = len(model["a"])
    short = [s for s in seqs if len(s) <= 2 * window]
    parts, before, after = list(short), [np.zeros(k)] * len(short), [np.ones(k)] * len(short)
    long_ = [[s[i : i + window] for i in range(0, len(s), window)] for s in seqs if len(s) > 2 * window]
    own = [x for ps in long_ for x in ps]
    starts = np.array([i == 0 for ps in long_ for i in range(len(ps))], bool)
    order = np.argsort([-len(x) for x in own], kind="stable")
    t = np.zeros((len(own), k, k))
    for at in range(0, len(own), 4096):
        some = order[at : at + 4096]
        t[some] = transfers(model, [own[i] for i in some], starts[some])
    at = 0
    for ps in long_:
        m = t[at : at + len(ps)]
        v, into, out = model["pi"], [np.zeros(k)], [np.ones(k)]
        for x in m[:-1]:
            v = v @ x
            v = v / v.sum()
            into.append(v)
        v = out[0]
        for x in m[:0:-1]:
            v = x @ v
            v = v / v.sum()
            out.append(v)
        parts += ps
        before += into
        after += out[::-1]
        at += len(ps)
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    at = 0
    for group in _grouped(parts):
        some = order[at : at + len(group)]
        yield group, np.array([before[i] for i in some]), np.array([after[i] for i in some])
        at += len(group)


def _grouped(seqs: list[np.ndarray], most: int = 400_000) -> Iterator[list[np.ndarray]]:
    """Longest first, in groups whose padded size stays bounded; a longer sequence stands alone."""
    seqs = sorted(seqs, key=len, reverse=True)
    at = 0
    while at < len(seqs):
        n = max(1, most // len(seqs[at]))
        yield seqs[at : at + n]
        at += n


def train(encoded: DataFrame, symbols: int, states: int = STATES, rounds: int = ROUNDS, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Baum-Welch over all training sequences. Each round, a partition gives its expected counts by symbol, which are summed by symbol; the model is the only thing that the driver holds."""
    spark = encoded.sparkSession
    seqs = encoded.filter("not held_out").select("symbols")
    cols = [f"s{k}" for k in range(states)]
    model = None
    for r in range(rounds + 1):
        shared = spark.sparkContext.broadcast(model)  # (states + symbols) * states numbers

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            m = shared.value
            xi, pi, emit = np.zeros((states, states)), np.zeros(states), np.zeros((symbols, states))
            for batch in batches:
                own = [np.frombuffer(x.as_py(), "<u2") for x in batch.column(0)]
                if m is None:
                    emit[:, 0] += np.bincount(np.concatenate(own), minlength=symbols)
                    continue
                for group, before, after in parts_of(m, own, window):
                    expected(m, group, xi, pi, emit, before, after)
            some = np.flatnonzero(emit.any(axis=1))
            rows, values = np.concatenate((some, -1 - np.arange(states), [-1 - states])), np.concatenate((emit[some], xi, pi[None]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *(pa.array(values[:, k]) for k in range(states))], ["row", *cols])

        sums = seqs.mapInArrow(run, "row int, " + ", ".join(f"{c} double" for c in cols)).groupBy("row").agg(*(F.sum(c).alias(c) for c in cols)).collect()  # symbols + states + 1 rows
        got = np.zeros((symbols + states + 1, states))
        for row in sums:
            got[row[0]] = row[1:]
        emit, pi, xi = got[:symbols], got[-1 - states], got[[-1 - k for k in range(states)]]
        if model is None:
            model = initial(emit[:, 0], states)
            continue
        b = emit.T + ALPHA / symbols
        model = {"pi": (pi + ALPHA) / (pi + ALPHA).sum(), "a": (xi + ALPHA) / (xi + ALPHA).sum(1, keepdims=True), "b": b / b.sum(1, keepdims=True)}
    return model


def scores(docs: DataFrame, held: str, states: int = STATES, symbols: int = SYMBOLS, rounds: int = ROUNDS) -> DataFrame:
    """Scores of all rows of docs (doc_id, text); rows where the SQL expression ``held`` is true teach nothing.

    A null or empty text is the end alone. Repeated rows count as often as they stand there. With no
    training rows, all words are unknown and the model is uniform. An empty table gives an empty
    result. ``score`` is log10 P(text): the model's likelihood of the symbols, and for each word
    outside the symbols its smoothed share of their mass.
    """
    spark = docs.sparkSession
    short_batches(spark)
    blocks = stored(_blocks(docs, held), "blocks")
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0
    summed = stored(_summed(_bucketed(blocks, int(n_words // BUCKET_WORDS) + 1), symbols), "sums")
    voc = _vocabulary(summed, symbols)
    encoded = stored(_encoded(blocks, summed, spark.sparkContext.broadcast(voc)), "encoded")
    model = spark.sparkContext.broadcast(train(encoded, symbols, states, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [np.frombuffer(x.as_py(), "<u2") for x in batch.column(6)]
            order = sorted(range(len(seqs)), key=lambda k: -len(seqs[k]))
            got, at = np.zeros(len(seqs)), 0
            for group in _grouped(seqs):
                got[order[at : at + len(group)]] = forward(model.value, group)
                at += len(group)
            score = pa.array(got + batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(np.full(len(seqs), voc.n), pa.int64()), batch.column(4), score], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
