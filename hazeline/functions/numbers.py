"""Numbers: coercion, means, half-even rounding, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def no_nan(value: Column) -> Column:
    """NaN counts as missing: it would pass ``>=`` filters and poison means.

    So does an infinite value, which is no measurement either.
    """
    return F.when(F.abs(value) < float("inf"), value)


def to_number(text: Column) -> Column:
    """Text to double, anything unreadable to null.

    The JVM also reads ``1.5f``, ``1.5d`` and hexadecimal; those are refused.
    """
    trimmed = F.trim(text.cast("string"))
    typed = F.lower(F.right(trimmed, F.lit(1))).isin("d", "f")
    infinite = F.lower(F.right(trimmed, F.lit(3))) == "inf"
    jvm_only = (typed & ~infinite) | F.lower(trimmed).contains("x")
    return no_nan(F.when(~jvm_only, trimmed.try_cast("double")))


def to_id(text: Column) -> Column:
    """Text to a whole-number id; ``12.0`` is 12, ``12.5`` is missing."""
    trimmed = F.trim(text.cast("string"))
    as_double = to_number(text)
    whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(trimmed.try_cast("bigint"), whole)


def mean_of(total: Column, n: Column) -> Column:
    """Mean from a sum of doubles and a count; null if there is no value.

    It is not rounded: labels, bands and displayed digits follow from all of it.
    """
    return F.try_divide(total, n)


def half_even(value: Column, places: int = 1) -> Column:
    return F.bround(value, places)


def display(value: Column) -> Column:
    """``1,234.5``, or a dash when there is no value."""
    return F.coalesce(F.format_number(value, 1), F.lit("—"))


def display_int(value: Column) -> Column:
    """``1,234``, the fraction cut off, or a dash when there is no value."""
    whole = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value))
    return F.coalesce(F.format_number(whole, 0), F.lit("—"))


def tooltip(value: Column) -> Column:
    """``1234.5`` without separators, or ``N/A``."""
    return F.coalesce(F.replace(F.format_number(value, 1), F.lit(","), F.lit("")), F.lit("N/A"))
