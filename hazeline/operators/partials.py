"""Mergeable partial aggregates.

Reports group the same measurements in several ways. Each starts from partial
sums that can be merged again, so rows shrink on the map side before anything
is shuffled, places are joined to sensors and not to measurements, and a sensor
with a third of all rows is one row per task by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.numbers import mean_of

ROWS, VALUES, TOTAL = "n_rows", "n_values", "value_total"
LOW, HIGH = "value_min", "value_max"


def measures() -> list:
    """The partial aggregates of measurement rows."""
    value = F.col("value")
    return [
        F.count(F.lit(1)).alias(ROWS),
        F.count(value).alias(VALUES),
        F.sum(value).alias(TOTAL),
        F.min(value).alias(LOW),
        F.max(value).alias(HIGH),
    ]


def partials(df: DataFrame, *keys: str) -> DataFrame:
    """Partial aggregates by keys, from measurements or from finer partials."""
    if TOTAL in df.columns:
        merged = [F.sum(c).alias(c) for c in (ROWS, VALUES, TOTAL)]
        merged += [F.min(LOW).alias(LOW), F.max(HIGH).alias(HIGH)]
    else:
        merged = measures()
    return df.groupBy(*keys).agg(*merged)


def mean():
    """Mean of the values behind partials; null if there are none."""
    return mean_of(F.col(TOTAL), F.col(VALUES))
