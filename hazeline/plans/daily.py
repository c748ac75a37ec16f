"""Readings to daily figures by sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["sensor_id", "parameter", "date"]


def daily_summary(readings: DataFrame, stamp: str = "datetime_utc") -> DataFrame:
    """Readings to one row per sensor, parameter and day, in one shuffle.

    The median is exact: its state is the count of each distinct value of one
    sensor's day, combined in the reading tasks first, so that a sensor with a
    large share of all rows sends each value of a day once per task. Missing keys
    form groups like others. Coverage is the share of the day's hours with a
    reading.
    """
    dated = readings.withColumn("date", F.to_date(stamp))
    hours = F.bit_count(F.bit_or(F.expr(f"shiftleft(1, hour({stamp}))")))
    return dated.groupBy(*KEYS).agg(
        F.avg("value").alias("value"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.round(hours * 100 / 24, 6).alias("coverage_percent"),
        F.count("value").alias("n"),
        F.median("value").alias("median"),
    )
