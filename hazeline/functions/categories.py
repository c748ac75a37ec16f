"""Concentration bands and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band limits in µg/m³ and the label sets that reports show.
BAND_LIMITS = [12, 35, 55, 150]
SHORT_LABELS = [
    "🟢 Good",
    "🟡 Moderate",
    "🟠 Unhealthy (Sensitive)",
    "🔴 Unhealthy",
    "🟣 Very Unhealthy",
]
LONG_LABELS = [
    "Good (0-12)",
    "Moderate (12-35)",
    "Unhealthy for Sensitive (35-55)",
    "Unhealthy (55-150)",
    "Very Unhealthy (150+)",
]
COLOURS = [[0, 228, 0], [255, 255, 0], [255, 126, 0], [255, 0, 0], [143, 63, 151]]
MISSING_LABEL = "Unknown"
MISSING_COLOUR = [128, 128, 128]
SEVERE_FROM = 200
SEVERE_LABEL = "🔴 SEVERE"
HIGH_LABEL = "🟠 HIGH"


def band(value: Column) -> Column:
    """0 to 4, or -1 for a missing value."""
    return F.when(value.isNull(), F.lit(-1)).otherwise(
        sum((F.when(value >= limit, 1).otherwise(0) for limit in BAND_LIMITS), F.lit(0))
    )


def _pick(index: Column, choices: list[Column], missing: Column) -> Column:
    picked = missing
    for i, choice in reversed(list(enumerate(choices))):
        picked = F.when(index == i, choice).otherwise(picked)
    return picked


def label(index: Column, labels: list[str]) -> Column:
    return _pick(index, [F.lit(text) for text in labels], F.lit(MISSING_LABEL))


def short_label(value: Column) -> Column:
    return label(band(value), SHORT_LABELS)


def long_label(value: Column) -> Column:
    return label(band(value), LONG_LABELS)


def colour(value: Column) -> Column:
    """Red, green and blue of the band as ``array<int>``; grey if missing."""
    rgb = [F.array(*[F.lit(part) for part in parts]) for parts in COLOURS]
    return _pick(band(value), rgb, F.array(*[F.lit(part) for part in MISSING_COLOUR]))


def severity(rounded: Column) -> Column:
    """Label of an extreme value; judged on the value as displayed."""
    return F.when(rounded >= SEVERE_FROM, F.lit(SEVERE_LABEL)).otherwise(F.lit(HIGH_LABEL))
