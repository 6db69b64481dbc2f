"""Quality rules: a threshold table compiled into one projection of native expressions.

Words are runs of characters other than space and 0x09-0x0D. A null text has no words and fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stop words of the four corpus languages (fixed values).
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not are this or",
    "fr": "le la les de des et un une du en que qui dans pour pas est sur par avec au elle",
    "de": "der die das und in zu den von mit ist im nicht ein eine auf für sich als auch dem",
    "es": "el la los de que y en un una por con no para las se del al como su es lo",
}
#: name, metric, lowest and highest value that pass (None: open).
THRESHOLDS = [
    ("too_few_words", "n_words", 20, None),
    ("word_length", "mean_word_chars", 1.5, 20.0),
    ("symbols", "symbol_ratio", None, 0.05),
    ("stop_words", "stop_word_ratio", 0.06, None),
    ("repeated_lines", "dup_line_ratio", None, 0.4),
    ("repeated_words", "repeat_word_ratio", None, 0.3),
]
_SPACE = "[ \\t-\\r]+"
_GAP = " \t\n\x0b\x0c\r"


def _window_hashes(words: Column, n: int = 8) -> Column:
    """64-bit hashes of all n-word windows of a text."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(F.array().cast("array<bigint>"))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measured columns of every row, one narrow projection chain without shuffle or user functions."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    d = docs.select(F.col(id_col), text.alias("_t"))
    d = d.withColumn("_w", F.filter(F.split("_t", _SPACE), lambda w: w != ""))
    d = d.withColumn("_h", _window_hashes(F.col("_w")))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.translate(x, _GAP, "") != ""))
    # Only texts with a repeated window pay for the sort of their windows.
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs))
    s = F.col("_s")
    twice = F.transform(
        s,
        lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]),
    )
    d = d.withColumn("_p", F.when(s.isNotNull(), F.sort_array(F.filter(twice, lambda i: i.isNotNull()))))
    p = F.col("_p")
    cover = F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(8), F.coalesce(F.get(p, k + 1) - x, F.lit(8)))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    measured = F.struct(
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.translate("_t", _GAP, "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(cover, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size("_l").cast("bigint").alias("n_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(stops))).cast("bigint").alias("n_stop_words"),
    )
    # A row's one struct is taken out by a generator, through which no later filter or projection is
    # pushed: else the optimizer would write the nested expressions out again at every use.
    return d.select(id_col, F.inline(F.array(measured)))


def judge(measured: DataFrame, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """Adds base_failed, kept and the names of the failed rules; the table is compiled into boolean expressions."""
    n = F.col("n_words")
    metrics = {
        "n_words": n,
        "mean_word_chars": F.try_divide(F.col("word_chars"), n),
        "symbol_ratio": F.try_divide(F.col("n_symbols"), F.col("word_chars")),
        "stop_word_ratio": F.try_divide(F.col("n_stop_words"), n),
        "dup_line_ratio": F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_word_ratio": F.try_divide(F.col("n_repeat_words"), n),
    }
    fails = []
    for name, metric, low, high in thresholds:
        x = F.coalesce(metrics[metric].cast("double"), F.lit(0.0))
        bad = (x < low) if low is not None else F.lit(False)
        bad = bad | (x > high) if high is not None else bad
        fails.append(F.when(bad, F.lit(name)))
    base = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    out = measured.withColumn("base_failed", base).withColumn("failed_rules", F.array_compact(F.array(*fails)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """Measures and judges every row; repeated rows are judged one by one, an empty table gives an empty result."""
    return judge(measure(docs, id_col, text_col), thresholds)
