"""A corpus pipeline of five stages; each one's result is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import minhash_dedup, mixing, packing, suffix_dedup, toxicity
from lodestrata.llm.work import stored
from lodestrata.session import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a model of the labels outside the held-out fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "crc32(coalesce(cast(doc_id as string), '')) % 5 <> 0")
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (four-word shingles, similarity 0.8)."""
    return minhash_dedup.without_near_duplicates(docs, shingle=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay at their first place only; all documents stay."""
    return suffix_dedup.without_repeats(docs, least=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of 1024."""
    return packing.pack_documents(docs, added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Near-duplicate components, model scores and tokenization are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
