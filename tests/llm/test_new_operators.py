import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import chat_format, collocations, html_extract, importance, language_id, media_ts
from lodestrata.llm import queries as q
from lodestrata.llm.textkit import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TALKS = "conv_id long, turn long, role string, text string"

# ---- chat formatting


def _prefixed(turns):
    return "<s>" + "".join(f"[{r}] {t}\n" for r, t in turns)


def _closed(turns):
    return "".join(f"<{r}>{t}" for r, t in turns) + "</s>"


def _forgets(turns):
    """Drops what earlier assistant turns thought."""
    last = len(turns) - 1
    return "".join(f"{r}> {t if k == last or r != 'assistant' else t.split('|')[-1]}\n" for k, (r, t) in enumerate(turns))


def _drops_first(turns):
    return "".join(f"{r}: {t}\n" for r, t in turns[-2:])


TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a:b", "=x", "", "User"]), st.text(alphabet="ab\\#</turn>: \n=é😀", max_size=30)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(TURNS)
def test_marked_turns_are_read_back(turns):
    assert chat_format.read_marked_turns(chat_format.marked_turns(turns)) == turns


@settings(max_examples=100, deadline=None)
@given(TURNS, st.integers(0, 2))
def test_located_turns_join_to_the_whole_output(turns, skip):
    skip = min(skip, len(turns))
    for render in (chat_format.marked_turns, _prefixed, _closed):
        found = chat_format.located(render, turns, skip)
        assert not any(x["rewrites"] for x in found)
        for (_, text), x in zip(turns[skip:], found, strict=True):
            got = x["formatted"][x["content_start"] : x["content_end"]]
            assert (chat_format.unescape(got) if render is chat_format.marked_turns else got) == text
        if not skip and turns:
            assert "".join(x["formatted"] for x in found) == render(turns)


@pytest.mark.parametrize("render", [_forgets, _drops_first])
def test_templates_that_rewrite_history_are_found(render):
    turns = [("user", "one"), ("assistant", "think|two"), ("user", "three"), ("assistant", "more|four")]
    found = chat_format.located(render, turns)
    assert [x["rewrites"] for x in found][:2] == [False, False] and any(x["rewrites"] for x in found)
    for k, x in enumerate(found):
        if x["rewrites"]:
            assert x["formatted"] == render(turns[: k + 1]) and x["formatted"][x["content_start"] : x["content_end"]] == turns[k][1]


def test_a_template_that_alters_texts_is_not_learnt_from():
    found = chat_format.located(lambda turns: "".join(f"{r}:{len(t)}\n" for r, t in turns), [("assistant", "long")])
    assert found[0]["content_start"] is None or found[0]["formatted"][found[0]["content_start"] : found[0]["content_end"]] != "long"


def _digests(rows):
    talks = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat_format.marked_turns(turns)))
    return out


@pytest.mark.parametrize("section", [64, 4])
def test_digests_of_odd_and_long_conversations(spark, monkeypatch, section):
    monkeypatch.setattr(chat_format, "SECTION", section)
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", None), (None, 3, "assistant", "\\ </turn>"), (None, None, None, "x"), (2, 5, "tool", ""), (3, 1, "other: </turn>", "### "), (4, 0, "assistant", "long " * 200_000)]
    rows += [(9, k, "assistant" if k % 2 else "user", f"turn {k} \\ ###") for k in range(200)] + [(8, 7, "assistant", f"tie {k % 3}") for k in range(30)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "s") for r in rows], TALKS + ", section string").repartition(5)
    got = chat_format.digests(chat_format.format_conversations(df)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got} == _digests(rows) and len(got) == len(_digests(rows))


def test_sections_say_what_is_learnt(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello")]
    (r,) = chat_format.format_conversations(spark.createDataFrame(rows, TALKS), lambda turns: "".join(f"<{r}>{t}" for r, t in turns) + "</s>").collect()
    assert "".join(x.formatted for x in r.turns) == _closed([x[2:] for x in rows]) and [x.loss for x in r.turns] == [False, False, True]
    assert chat_format.format_conversations(spark.createDataFrame([], TALKS)).count() == 0


# ---- importance resampling


PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text):
    w = PATTERN.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .é😀\x7f\x00_", max_size=60)), max_size=8), st.sampled_from([1, 3, 1 << 19]))
def test_composed_crcs_equal_those_of_the_strings(texts, part):
    texts = [*texts, "x" * 33 + " " + "y" * 32 + " " + "z" * 70_000 + " end"]
    importance._PART = part
    got = [(int(r), int(c)) for crc, row in importance.features(Words(pa.array(texts, pa.string()), apart=importance.APART)) for c, r in zip(crc, row, strict=True)]
    importance._PART = 1 << 19
    assert sorted(got) == sorted((r, c) for r, t in enumerate(texts) for c in _features(t)[1])


def test_moving_a_crc_by_any_length():
    for n in (0, 1, 63, 64, 1000, 123_457):
        a, b = b"first", bytes(range(256)) * (n // 256) + bytes(n % 256)
        assert int(importance.moved(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0]) ^ zlib.crc32(b) == zlib.crc32(a + b)


def _resampled(docs, target, percent=5):
    s, t = collections.Counter(), collections.Counter()
    for counts, texts in ((s, docs), (t, target)):
        for _, text in texts:
            counts.update(c % 10_000 for c in _features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)]
    rows = []
    for doc_id, text in docs:
        n, f = _features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % 10_000] for c in f)
        rows.append((n, doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= 20), key=lambda r: (-r[4], r[1] is None, r[1]))
    ranks = collections.defaultdict(list)
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        ranks[r[1:]].append(k)
    return sorted(((*r[1:], ranks[r[1:]].pop(0) if ranks[r[1:]] else None) for r in rows), key=repr)


def test_resampling_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "γάμμα", "d4", "e" * 40, "zeta"]
    docs = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(60)))) for k in range(300)] + [(7, "alpha " * 30), (7, "alpha " * 30), (None, "Beta d4 " * 20), (None, None), (900, None), (901, ""), (902, " . "), (903, "alpha zeta " * 100_000)]
    target = [(1, "alpha zeta alpha zeta"), (2, None), (3, "ALPHA d4")]
    df = spark.createDataFrame([(*d, None, "x", "y") for d in docs], "doc_id long, text string, n_words long, bucket string, weight string").repartition(4)
    tf = spark.createDataFrame([(i, t, 1) for i, t in target], "item_id long, text string, bucket long")
    got = importance.resample(df, tf).collect()
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got), key=repr) == _resampled(docs, target)
    assert sum(r["rank"] is not None for r in got) == sum(_features(t)[0] >= 20 for _, t in docs) * 5 // 100 > 5


def test_resampling_of_empty_tables(spark):
    none, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert importance.resample(none, one).count() == 0
    (r,) = importance.resample(one, none).collect()
    assert (r.n_features, r.weight, r["rank"]) == (3, 3 * math.floor(1000 * math.log(10003 * 1 / (2 * 10000))), None)


def test_resampling_query_equals_brute_force_on_the_small_tables(spark, tiny):
    docs = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    target = [tuple(r) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()]
    got = q.QUERIES["op12_importance_resampling"](spark, tiny)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _resampled(docs, target)


# ---- collocations


def _phrase_counts(docs, most=5):
    n, f = collections.Counter(), collections.defaultdict(collections.Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for k in range(1, most + 1):
                f["und" if lang is None else lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    return n, f


def _collocations(docs, least, first):
    n, counts = _phrase_counts(docs)
    out = []
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if a >= least and " " in p}
        gone = set()
        for p, a in able.items():
            w = p.split(" ")
            gone |= {x for k in range(2, len(w)) for i in range(len(w) - k + 1) if (x := " ".join(w[i : i + k])) in able and 100 * a >= 100 * able[x]}
        rows = []
        for p, a in able.items():
            if p not in gone:
                w = p.split(" ")
                score, _, x, y = min((1000 * a * n[lang] // (f[x] * f[y]), k, f[x], f[y]) for k in range(1, len(w)) for x, y in [(" ".join(w[:k]), " ".join(w[k:]))])
                rows.append((-score, -a, p.encode(), a, x, y, score))
        out += [(lang, r, p.decode(), a, x, y, n[lang], score) for r, (_, _, p, a, x, y, score) in enumerate(sorted(rows)[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard,bits", [(1 << 21, 26), (7, 26), (50, 12)])
def test_collocations_equal_brute_force(spark, shard, bits):
    rng = random.Random(5)
    vocab = ["new", "York", "of", "the", "Éa", "x\x00y", "😀"]
    docs = [(rng.choice(["en", "fr", None, "", "a\nb"]), " ".join(rng.choice(vocab) + rng.choice(["", "", "", ".", "\n", ",", "\t"]) for _ in range(rng.randrange(80)))) for _ in range(60)]
    docs += [("en", "united states of america stands"), ("en", None), ("en", ""), (None, "\r\n,,;")] * 6 + [("de", "eins zwei drei " * 300)]
    df = spark.createDataFrame([(k, t, lang, "n", 1) for k, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string, words string, phrase long").repartition(3)
    got = collocations.collocations(df, least=5, first=40, size=shard, most_bits=bits)
    want = [r for r in _collocations(docs, 5, 40)]
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == want
    assert len(want) > 60


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


def test_large_scores_are_exact(spark):
    texts = spark.createDataFrame([("en", 1, "a", 3 * 10**12 + 1), ("en", 1, "b", 10**12 + 7), ("en", 2, "a b", 10**12 + 7)], "lang string, words int, phrase string, n long")
    totals = spark.createDataFrame([("en", 10**13 + 9)], "lang string, n long")
    (r,) = collocations.scored(totals, texts).collect()
    assert r.score == 1000 * (10**12 + 7) * (10**13 + 9) // ((3 * 10**12 + 1) * (10**12 + 7))


def test_suffix_order_and_intervals():
    words = "a b a b c a b".split()
    d = pa.array(words).dictionary_encode()
    s = collocations.Shard(d.dictionary, d.indices.to_numpy(), np.zeros(7, np.int64), np.array([0, 0, 0, 0, 1, 0, 1], bool), 7)
    order = s.suffixes(1, 5)
    piece = [words[:5], words[5:]]
    suffix = lambda i: piece[0][i:] if i < 5 else piece[1][i - 5 :]
    ranks = [[d.dictionary.to_pylist().index(x) for x in suffix(i)] for i in order]
    assert ranks == sorted(ranks)
    for k in range(1, 6):
        at, n = s.intervals(order, s.common(order, 5), k)
        want = collections.Counter(tuple(p[i : i + k]) for p in piece for i in range(len(p) - k + 1))
        assert {tuple(suffix(a)[:k]): int(c) for a, c in zip(at, n, strict=True)} == want


@pytest.mark.parametrize("name", ["op11_chat_formatting", "op13_phrase_collocations"])
def test_new_queries_equal_their_sql(spark, tiny, same, name):
    same(spark, q.QUERIES[name], q.ORACLES[name], tiny)


# ---- odd markup


@pytest.mark.parametrize("unit", ["<a ", "<h1>", "<b></i>", "<header>", "</script ", "<div></p>", '<a "', "<a 'x", "<li>", "</", '<a="', "<!--", "<td><b>"])
def test_pages_of_unclosed_markup_take_time_in_proportion(unit):
    def seconds(n):
        page = "<html><body><article><p>Kept text.</p>" + unit * (n // len(unit))
        start = time.process_time()
        text = html_extract.Page(page).main_text(set())
        assert text.startswith("Kept text.")
        return time.process_time() - start

    seconds(1000)
    assert seconds(400_000) < 4


def test_what_follows_the_last_tag_is_text_or_a_comment():
    text = lambda h: html_extract.Page(h).main_text(set())
    assert text("<p>a</p>b < c") == "a\n\nb < c" and text("<p>a</p>b<a href=") == "a\n\nb" and text("<p>a</p>b<!-- c") == "a\n\nb" and text("<!--><p>a</p>") == "" and text("<!-- x --><p>a</p>") == "a"
    assert text("<p>a</p><script>b</script ") == "a" and text("no tags") == "no tags"


# ---- earlier operators, by independent means


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abÉ1 .́\n", max_size=40), min_size=1, max_size=6), st.integers(1, 9))
def test_grams_of_pieces_count_exactly_as_the_whole(texts, piece):
    whole, n = language_id.ngram_counts(texts)
    parts, m = language_id.ngram_counts(texts, piece=piece)
    assert (whole == parts).all() and (n == m).all()
    for k, t in enumerate(texts):  # and the whole by a regular expression: each run that is no letter or mark is one space
        plain = re.sub("[^abé́]+", " ", f" {t.lower()} ").lstrip()
        assert whole[k].sum() == sum(max(0, len(plain) - n + 1) for n in language_id.ORDERS)


def test_language_by_brute_force(spark):
    """Nearest centroid by cosine of log-count times inverse document frequency, computed text by text without numpy's matrices."""
    words = {"aa": ["wal", "wop", "wik"], "bb": ["zun", "zer", "zot"], "cc": ["mil", "mon", "zun"]}
    rng = random.Random(8)
    train = [(k, " ".join(rng.choice(words[lang]) for _ in range(12)), lang) for k, lang in enumerate(["aa", "bb", "cc"] * 20)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    texts = [" ".join(rng.choice(words[lang] + ["wal"]) for _ in range(rng.randrange(1, 30))) for lang in ["aa", "bb", "cc"] * 8] + ["", None, "123"]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    df = collections.Counter(g for _, t, _ in train for g in set(np.flatnonzero(language_id.ngram_counts([t])[0][0]).tolist()))
    for k, t in enumerate(texts):
        if not t or t == "123":
            assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
            continue
        counts = language_id.ngram_counts([t])[0][0]
        v = {int(g): math.log1p(counts[g]) * (math.log((1 + len(train)) / (1 + df[int(g)])) + 1) for g in np.flatnonzero(counts)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        best = max((sum(x * float(c[g]) for g, x in v.items()) / norm, lang) for c, lang in zip(model["centroids"], model["langs"], strict=True))
        assert got[k].score == pytest.approx(best[0], abs=1e-4) and got[k].lang_pred == best[1]


def test_a_transport_stream_that_the_muxer_did_not_make():
    """Table sections as other muxers write them, with their published checksums, and elementary packets laid out by hand."""
    fill = lambda b: b + b"\xff" * (188 - len(b))
    pat = fill(bytes.fromhex("474000100000b00d0001c100000001f0002ab104b2"))
    pmt = fill(bytes.fromhex("475000100002b0120001c10000e100f0001be100f00015bd4d56"))
    # PTS 0x1_2345_6789: bits 32-30, 29-15 and 14-0, each followed by a marker bit.
    pts = 0x123456789
    stamp = bytes([0x20 | (pts >> 30 & 7) << 1 | 1]) + ((pts >> 15 & 0x7FFF) << 1 | 1).to_bytes(2, "big") + ((pts & 0x7FFF) << 1 | 1).to_bytes(2, "big")
    first = bytes.fromhex("000001e00000808005") + stamp + b"A" * 100
    head = bytes([0x47, 0x41, 0x00, 0x30, 188 - 5 - len(first)]) + b"\x40" + b"\xff" * (188 - 6 - len(first)) + first  # random access
    second = bytes([0x47, 0x01, 0x00, 0x11]) + b"B" * 184
    lost = bytes([0x47, 0x01, 0x00, 0x13]) + b"C" * 184  # counter 2 is missing
    unit = bytes.fromhex("000001e0000d800000") + b"D" * 10
    last = bytes([0x47, 0x41, 0x00, 0x34, 188 - 5 - len(unit)]) + b"\x00" + b"\xff" * (188 - 6 - len(unit)) + unit
    got = media_ts.demux(pat + pmt + head + second + second + lost + last)
    assert (got["programs"], got["streams"], got["crc_errors"]) == ({1: 0x1000}, {0x100: 0x1B}, 0)
    assert got["payload"] == b"A" * 100 + b"B" * 184 + b"C" * 184 + b"D" * 10
    assert got["pts"] == [pts, None] and got["rap"] == [True, False] and got["cc_errors"] == 1 and got["sync_errors"] == 0
    broken = media_ts.demux(pat[:20] + b"\x00" + pat[21:] + pmt)
    assert broken["crc_errors"] == 1 and broken["programs"] == {}
