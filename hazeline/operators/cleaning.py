"""Ingest cleaning: coercion, range filter, quarantine, in-batch dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.dates import local_clock, parse_date_text, utc_clock
from hazeline.functions.numbers import to_id, to_number
from hazeline.operators.pick import first_per_key
from hazeline.schemas import FACT, KEY, require

_NUMBERS = ["value", "coverage_percent", "min", "max", "median", "latitude", "longitude"]


def prepare_measurements(df: DataFrame) -> DataFrame:
    """Text as it landed to the types of the fact table.

    Times become wall clocks without zone, bad numbers become missing. Text
    columns keep their nulls. Other columns pass through.
    """
    require(df, FACT.names, "measurement frame")
    typed = {name: to_number(F.col(name)) for name in _NUMBERS}
    typed["sensor_id"] = to_id(F.col("sensor_id"))
    typed["parameter"] = F.col("parameter").cast("string")
    typed["units"] = F.col("units").cast("string")
    for name, parse in (("datetime_utc", utc_clock), ("datetime_local", local_clock)):
        if df.schema[name].dataType.simpleString() == "string":
            typed[name] = parse(F.col(name))
        else:
            typed[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(typed)


def in_range(stamp: Column, start=None, end=None) -> Column:
    """Both ends inclusive; an end that is missing does not filter.

    Ends are date text in any form ``parse_date_text`` reads, or datetimes.
    """
    inside = F.lit(True)
    if start is not None:
        inside = inside & (stamp >= _bound(start))
    if end is not None:
        inside = inside & (stamp <= _bound(end))
    return inside


def filter_range(df: DataFrame, start=None, end=None) -> DataFrame:
    return df.where(in_range(F.col("datetime_utc"), start, end))


def _bound(value) -> Column:
    if not isinstance(value, str):
        return F.lit(value).cast("timestamp_ntz")
    text = value.strip()
    if text.endswith("Z"):
        return utc_clock(F.lit(text))
    parsed = parse_date_text(F.lit(text))
    return F.coalesce(parsed, F.raise_error(F.lit(f"not a date: {text}")).cast("timestamp_ntz"))


def is_unstorable(df: DataFrame) -> Column:
    """Rows the fact table refuses: a key column or the local time is missing."""
    missing = [F.col(name).isNull() for name in [*KEY, "datetime_local"]]
    bad = missing[0]
    for test in missing[1:]:
        bad = bad | test
    return bad


def dedup_first(df: DataFrame, arrival, keys=None) -> DataFrame:
    """In-batch dedup: of the rows with one key, the first to arrive stays."""
    keys = keys or KEY
    require(df, keys, "measurement frame")
    return first_per_key(df, keys, arrival)
