"""Enriched measurements, and the full filter the reports share."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators import filters
from hazeline.operators.places import Directory, attach_to_sensors, enrich
from hazeline.operators.prefilter import keep_chosen_sensors
from hazeline.sources.tables import scan_parameter


@dataclass(frozen=True)
class Selection:
    """What a report covers. An empty selection covers everything."""

    start: dt.date | None = None
    end: dt.date | None = None
    states: Sequence[str] = ()
    cities: Sequence[str] = ()
    threshold: float | None = None

    @property
    def by_place(self) -> bool:
        return bool(self.states or self.cities)


def load_measurements(facts: DataFrame, where: Directory, parameter: str = "pm25") -> DataFrame:
    """Measurements of one parameter with date and place."""
    return enrich(scan_parameter(facts, parameter), where)


def select_rows(df: DataFrame, selection: Selection) -> DataFrame:
    """Apply the parts of a selection that measurement rows can answer."""
    dated = filters.filter_date(df, selection.start, selection.end)
    return filters.filter_threshold(dated, selection.threshold)


def select_places(df: DataFrame, selection: Selection) -> DataFrame:
    """Apply the parts of a selection that need state and city."""
    return filters.filter_city(filters.filter_state(df, selection.states), selection.cities)


def select_at_scan(df: DataFrame, where: Directory, selection: Selection) -> DataFrame:
    """The rows that a selection needs, cut where they are read; places are still to be checked."""
    return keep_chosen_sensors(select_rows(df, selection), where, selection.states, selection.cities)


def filter_all(df: DataFrame, where: Directory, selection: Selection) -> DataFrame:
    """Enriched rows that pass date, state, city and threshold.

    Sensors elsewhere are left out by the scan, so only rows of chosen places are joined.
    """
    return select_places(enrich(select_at_scan(df, where, selection), where), selection)


def sensor_metadata(facts: DataFrame, where: Directory) -> DataFrame:
    """Mean position and last time by sensor and parameter, with the place."""
    grouped = facts.groupBy("sensor_id", "parameter").agg(
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
        F.max("datetime_utc").alias("last_seen"),
    )
    return attach_to_sensors(grouped, where).select(
        "sensor_id",
        "parameter",
        "latitude",
        "longitude",
        "last_seen",
        "location_id",
        "state",
        "city",
        "location_name",
    )
