"""Overlapping text windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import strip


def chunk_text(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 1200, overlap: int = 200) -> DataFrame:
    """(key, chunk_index, chunk): windows of ``size`` characters at every ``max(1, size - overlap)``, trimmed, empty ones dropped and the rest numbered anew.

    A last window that lies wholly in the one before it is kept. Null and blank texts have none.
    """
    step = max(1, size - overlap)
    t = strip(F.col(text))
    d = docs.select(key, t.alias("_t")).filter(F.length("_t") > 0)
    # A text's windows are made and numbered in its own row: no shuffle.
    windows = F.transform(F.sequence(F.lit(0), F.length("_t") - 1, F.lit(step)), lambda at: strip(F.substring("_t", at + 1, F.lit(size))))
    return d.select(key, F.posexplode(F.filter(windows, lambda c: c != "")).alias("chunk_index", "chunk"))
