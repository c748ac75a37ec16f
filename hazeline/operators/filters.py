"""Report filters and the figures that feed their controls."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.text import location_list
from hazeline.operators.places import Directory, attach_to_sensors
from hazeline.operators.sizing import keep_listed

# The named report scenarios and their thresholds in µg/m³.
SCENARIO_THRESHOLDS = {
    "Base Case (All Data)": None,
    "AQI Watch (≥35 µg/m³)": 35,
    "Severe Episode (≥55 µg/m³)": 55,
}


def filter_date(
    df: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """UTC dates, both ends inclusive; an open end takes all there is.

    Written on datetime_utc itself so that the scan can skip row groups, and
    on the month where the frame has that partition column.
    """
    if start is not None:
        df = df.where(F.col("datetime_utc") >= F.lit(start).cast("timestamp_ntz"))
        if "month" in df.columns:
            df = df.where(F.col("month") >= f"{start:%Y-%m}")
    if end is not None:
        after = end + dt.timedelta(days=1)
        df = df.where(F.col("datetime_utc") < F.lit(after).cast("timestamp_ntz"))
        if "month" in df.columns:
            df = df.where(F.col("month") <= f"{end:%Y-%m}")
    return df


def filter_in(df: DataFrame, column: str, chosen: Sequence | DataFrame | None) -> DataFrame:
    """Rows whose column is among the chosen values; no choice keeps all.

    A list table is looked up; a Python list becomes IN.
    """
    if isinstance(chosen, DataFrame):
        return keep_listed(df, chosen, column)
    return df.where(F.col(column).isin(list(chosen))) if chosen else df


def filter_state(df: DataFrame, states: Sequence[str] | DataFrame | None) -> DataFrame:
    return filter_in(df, "state", states)


def filter_city(df: DataFrame, cities: Sequence[str] | DataFrame | None) -> DataFrame:
    """By bare city name, as one name may occur in several states."""
    return filter_in(df, "city", cities)


def filter_threshold(df: DataFrame, threshold: float | None) -> DataFrame:
    """Missing values never pass; NaN was made missing when the row was read."""
    return df if threshold is None else df.where(F.col("value") >= threshold)


def filter_scenario(df: DataFrame, scenario: str) -> DataFrame:
    return filter_threshold(df, SCENARIO_THRESHOLDS[scenario])


def requested_locations(spark: SparkSession, override: str | None, known: DataFrame) -> DataFrame:
    """Location ids a job works on: the override list, else all known ones."""
    if override:
        return location_list(spark, override)
    return known.select("location_id").distinct()


def filter_locations(df: DataFrame, allowed: DataFrame, column: str = "location_id") -> DataFrame:
    """Only rows of listed locations."""
    return keep_listed(df, allowed.select(F.col("location_id").alias(column)), column)


def date_bounds(df: DataFrame) -> DataFrame:
    bounds = df.agg(F.min("datetime_utc").alias("lo"), F.max("datetime_utc").alias("hi"))
    return bounds.select(
        F.to_date("lo").alias("min_date"),
        F.to_date("hi").alias("max_date"),
    )


def _places_in_use(df: DataFrame, where: Directory) -> DataFrame:
    """Sensors first, places second: the join sees one row per sensor."""
    return attach_to_sensors(df.select("sensor_id").distinct(), where)


def state_options(df: DataFrame, where: Directory) -> DataFrame:
    return _places_in_use(df, where).select("state").distinct().orderBy("state")


def city_options(df: DataFrame, where: Directory, states: Sequence[str] = ()) -> DataFrame:
    """Cities to choose from, narrowed by the states already chosen."""
    places = filter_state(_places_in_use(df, where), states)
    return places.select("city").distinct().orderBy("city")
