"""Numeric, date and unit functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.text import blank_to_null, clean, strip

_NUMBER = r"(?i)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"

#: Factors to Pa by unit; gold data also take rates and blanks (fixed values).
STRESS = {"pa": 1.0, "kpa": 1e3, "mpa": 1e6, "gpa": 1e9}
GOLD_UNITS = STRESS | {"1/s": 1.0, "s^-1": 1.0, "": 1.0}


def to_float(c: Column) -> Column:
    """A number's text as double, null where it is none; digits may be grouped by '_', and 'd'/'f' suffixes are no numbers."""
    s = strip(c.cast("string"))
    return F.when(s.rlike(_NUMBER), F.replace(s, F.lit("_"), F.lit(""))).try_cast("double")


def float_or_zero(c: Column) -> Column:
    return F.coalesce(to_float(c), F.lit(0.0))


def int_or_zero(c: Column) -> Column:
    """Whole numbers only: '12.0' counts as 0."""
    s = strip(c.cast("string"))
    return F.coalesce(F.when(s.rlike(r"^[+-]?\d+$"), s).try_cast("bigint"), F.lit(0))


def factor(unit: Column, table: dict[str, float] = STRESS) -> Column:
    """SI factor of a unit, null where unknown."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), clean(unit))


def almost_equal(a: Column, b: Column, atol: float = 1e-9, rtol: float = 1e-6) -> Column:
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b))


def value_mismatch(gold: Column, pred: Column, share: float = 0.05) -> Column:
    return F.abs(gold - pred) > F.greatest(F.lit(1e-6), share * F.abs(gold))


def prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """Precision, recall and F1; 0 where undefined."""
    zero = F.lit(0.0)
    p, r = F.coalesce(F.try_divide(tp, tp + fp), zero), F.coalesce(F.try_divide(tp, tp + fn), zero)
    return p, r, F.coalesce(F.try_divide(2 * p * r, p + r), zero)


def year_of(c: Column) -> Column:
    """The four digits that a date begins with."""
    return blank_to_null(F.regexp_extract(c.cast("string"), r"^(\d{4})", 1)).try_cast("int")


def number_or_text(c: Column) -> Column:
    """A number as its shortest text, anything else trimmed; null where blank."""
    n = to_float(c)
    whole = (n == F.floor(n)) & (F.abs(n) < 1e15)
    return F.when(n.isNotNull(), F.when(whole, n.cast("bigint").cast("string")).otherwise(n.cast("string"))).otherwise(blank_to_null(strip(c.cast("string"))))
