"""Queries of the training-data operators over the whole tables, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestrata.llm import chat_format, collocations, hmm_score, html_extract, importance, language_id, media_ts, minhash_dedup, mixing, packing, quality_rules, suffix_dedup, toxicity
from lodestrata.llm.work import stored
from lodestrata.session import table

QUERIES: dict = {}
ORACLES: dict = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op7_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, added=True).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op8_media_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    read = media_ts.read_media(stored(media_ts.store_media(docs), "media"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", F.size("pts").alias("n_units"), F.size("random_access").alias("n_random_access"))


@_query
def op9_quality_rules(spark, sf_dir):
    q = quality_rules.quality(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for ws in quality_rules.STOP_WORDS.values() for w in ws.split()}))


def _rule_sql() -> str:
    metric = {
        "n_words": "n_words",
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbol_ratio": "n_symbols / nullif(word_chars, 0)",
        "stop_word_ratio": "n_stop_words / nullif(n_words, 0)",
        "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "repeat_word_ratio": "n_repeat_words / nullif(n_words, 0)",
    }
    parts = []
    for _, name, low, high in quality_rules.THRESHOLDS:
        x = f"coalesce({metric[name]}, 0)"
        parts += [f"{x} >= {low}"] if low is not None else []
        parts += [f"{x} <= {high}"] if high is not None else []
    return " AND ".join(parts)


_SP = r"[ \t\n\x0b\x0c\r]"
ORACLES["op9_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^ \t\n\x0b\x0c\r]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '{_SP}', '', 'g')) > 0) AS l FROM d),
g AS (
  SELECT r, i, w[i:i + 7] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
two AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
cover AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM two) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_SP}', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: list_contains([{_STOPS}], lower(x)))) AS n_stop_words
  FROM w LEFT JOIN cover USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {_rule_sql()}) AS kept
FROM m
"""


@_query
def op10_mixing_sources(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


ORACLES["op10_mixing_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t\n\x0b\x0c\r]+')), 0)::BIGINT AS size,
         md5(concat_ws('|', doc_id::VARCHAR, 'mix')) AS k FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER b, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS open_weight
  FROM s WINDOW b AS (ORDER BY most / weight, source IS NULL, source COLLATE "C" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, rest / open_weight >= most / weight AS is_full FROM f),
lv AS (SELECT arg_min({'r': rest, 'w': open_weight}, most / weight) AS l FROM g WHERE NOT is_full),
t AS (
  SELECT source, source_size, (CASE WHEN is_full THEN most::DOUBLE ELSE (weight * (SELECT l.r FROM lv))::DOUBLE / (SELECT l.w FROM lv) END)::DOUBLE AS target FROM g),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source, floor(target + 0.5)::BIGINT AS budget,
         (sum(size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
       (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * size
        + greatest(0, least(size, budget - CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END * source_size - before)))::BIGINT AS taken
FROM p
"""


@_query
def op2_minhash_near_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op2_minhash_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0b\x0c\r]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id WHERE a.g IN (SELECT g FROM f) GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a),
c AS (SELECT a, least(a, min(b)) AS m FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.m, d.doc_id) AS component_id, coalesce(c.m, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""


@_query
def op6_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("digest")


def _fold(n: int) -> str:
    """Whether a document is held out: crc32 of its id as text is divisible by n."""
    return f"crc32(coalesce(cast(doc_id as string), '')) % {n} = 0"


@_query
def op4_lm_scoring(spark, sf_dir):
    return hmm_score.scores(table(spark, sf_dir, "documents"), _fold(10))


@_query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), f"NOT ({_fold(5)})")
    out = toxicity.score(docs, model).withColumn("held_out", F.expr(_fold(5)))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "evidence")


@_query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(f"NOT ({_fold(5)})"))
    out = language_id.predict(docs, model).withColumn("held_out", F.expr(_fold(5)))
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@_query
def op3_html_extraction(spark, sf_dir):
    return html_extract.extract(table(spark, sf_dir, "pages"))


_MARKED = r"\### Assistant: </turn> ok"


@_query
def op11_chat_formatting(spark, sf_dir):
    more = spark.createDataFrame([(-7, 0, "user", _MARKED), (-7, 1, "assistant", _MARKED)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat_format.digests(chat_format.format_conversations(rows))


_IN_ORDER = "ORDER BY turn NULLS FIRST, role, text"
ORACLES["op11_chat_formatting"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_MARKED}' UNION ALL SELECT -7, 1, 'assistant', '{_MARKED}'),
f AS (
  SELECT *, CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN length(role)
                 ELSE 1 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:|=')) END
            + length(text) + len(regexp_extract_all(text, '\\|###|</turn>')) + length('### : ' || ' </turn>' || chr(10)) AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_IN_ORDER})) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' {_IN_ORDER})) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


@_query
def op12_importance_resampling(spark, sf_dir):
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_query
def op13_phrase_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op13_phrase_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^ \t]+') AS w FROM d),
g AS (
  SELECT lang, k, unnest(CASE WHEN len(w) < k THEN [] ELSE list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')) END) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM g GROUP BY 1, 2, 3),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 100),
i AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, a FROM (SELECT lang, w, a, k, m, unnest(range(1, k - m + 2)) AS s FROM (SELECT lang, w, a, k, unnest(range(2, k)) AS m FROM c)))
  GROUP BY 1, 2),
u AS (SELECT c.* FROM c LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
x AS (SELECT lang, phrase, a, h, array_to_string(w[1:h], ' ') AS lp, array_to_string(w[h + 1:k], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS h FROM u)),
y AS (
  SELECT x.lang, x.phrase, x.a, x.h, p.f AS l, q.f AS r, t.n, 1000 * x.a * t.n // (p.f * q.f) AS score
  FROM x JOIN f p ON p.lang = x.lang AND p.phrase = x.lp JOIN f q ON q.lang = x.lang AND q.phrase = x.rp JOIN t ON t.lang = x.lang),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) AS o FROM y),
v AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM z WHERE o = 1)
SELECT * FROM v WHERE rank <= 2000
"""
