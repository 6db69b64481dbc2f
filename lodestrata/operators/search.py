"""Bibliographic search: score, deduplicate, filter with reasons, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.text import blank_to_null, squeeze
from lodestrata.operators.numbering import numbered
from lodestrata.operators.pick import first_by


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """How many keywords are substrings of the lower-cased text; a repeated keyword counts repeatedly, an empty one never."""

    def score(t: Column) -> Column:
        out = F.lit(0)
        for k in keywords:
            if k:
                out = out + F.when(F.contains(t, F.lit(k.lower())), 1).otherwise(0)
        return out

    # Bound to a variable, so that a filter, too, lower-cases the text once and not for each keyword.
    return F.transform(F.array(F.coalesce(F.lower(text), F.lit(""))), score)[0]


def keyword_score_squeezed(text: Column, keywords: list[str]) -> Column:
    return keyword_score(squeeze(text), keywords)


def keep_best(rows: DataFrame, keys: list[str], score: str, order: list[str]) -> DataFrame:
    """The best row of each key, earliest among equals, with ``position``: where its key was first seen."""
    seen = F.min(F.col(order[0]) if len(order) == 1 else F.struct(*order)).alias("position")
    return first_by(rows, keys, [-F.col(score), *order], seen)


def keep_first(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key in order."""
    return first_by(rows, [key], order)


def drop_reason(doi: Column, doctype: Column, year: Column, allowed: list[str], year_from: int | None, year_to: int | None, require_doi: bool = True) -> Column:
    """The first rule that a record fails, else null. An empty doctype and a null year pass."""
    out = F.when(F.lit(require_doi) & (F.coalesce(doi, F.lit("")) == ""), "no_doi")
    if allowed:
        out = out.when((F.coalesce(doctype, F.lit("")) != "") & ~doctype.isin(allowed), "doctype")
    if year_from is not None:
        out = out.when(year < year_from, "year")
    if year_to is not None:
        out = out.when(year > year_to, "year")
    return out


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(reason), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def search_report(rows: DataFrame, key: str, reason: str = "reason") -> DataFrame:
    """One row: raw, deduplicated and kept counts, and the drops by reason."""
    r = F.col(reason)
    return rows.agg(
        F.count("*").alias("raw"), F.countDistinct(key).alias("dedup"), F.count_if(r.isNull()).alias("kept"),
        F.count_if(r == "no_doi").alias("dropped_no_doi"), F.count_if(r == "doctype").alias("dropped_doctype"), F.count_if(r == "year").alias("dropped_year"),
    )


def entry_key(doi: Column, eid: Column, title: Column) -> Column:
    """What a search entry is deduplicated by: its DOI (lower-cased), else its id, else its title."""
    return F.coalesce(F.lower(blank_to_null(doi)), blank_to_null(eid), blank_to_null(title))


def rank(rows: DataFrame, score: str, order: list[str]) -> DataFrame:
    """By score, best first; equal ones keep their order."""
    return rows.orderBy(F.desc(score), *order)


def ranked(rows: DataFrame, score: str, order: list[str]) -> DataFrame:
    """All rows with their ``rank`` in that order, from 1."""
    return numbered(rows, [F.desc(score), *order], "rank")
