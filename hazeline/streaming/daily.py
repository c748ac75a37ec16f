"""Daily figures of a stream, kept as one folder per day that is rewritten when it changes.

The table is the state. Beside its figures a row holds what they merge from: the hours
with a reading, and how often each value came. So the median is exact, the figures are
those of the batch job, and a micro-batch reads and writes the days it touches and no
others. The number of folders follows the days, not the micro-batches.

A micro-batch that runs again changes nothing twice: the merged days are written beside
the table first, under its number, and what is found there complete is put in place again
instead of being merged again.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.sources.files import child_names, exists

FIGURES = ["value", "min", "max", "coverage_percent", "n", "median"]
_COUNTS = "array<struct<value:double,n:bigint>>"
_UNITS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "second": 1}


class Progress(NamedTuple):
    """How far a sink is: the last micro-batch, the latest time, and rows that came too late so far."""

    number: int = -1
    high: dt.datetime | None = None
    late: int = 0


_PROGRESS = T.StructType().add("number", "long").add("high", "timestamp_ntz").add("late", "long")


class DailySink:
    """Daily figures by ``keys`` below ``path``.

    A row is late, and counted instead of added, if its day ended at or before the latest
    time of the micro-batches before, less ``delay``. Rows without a time have no day and
    are left out. Missing keys form groups like others.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], delay: str = "2 days"):
        self.spark, self.path, self.keys, self.delay = spark, path, list(keys), _span(delay)

    def progress(self) -> Progress:
        """Two folders take turns, so that one is whole at any time."""
        folders = [f"{self.path}/progress/turn={i}" for i in (0, 1)]
        whole = [f for f in folders if exists(self.spark, f"{f}/_SUCCESS")]
        rows = self.spark.read.schema(_PROGRESS).parquet(*whole).collect() if whole else []
        return max((Progress(*row) for row in rows), key=lambda p: p.number, default=Progress())

    def update(self, batch: DataFrame, number: int) -> None:
        """Add the rows of one micro-batch."""
        before = self.progress()
        if before.number >= number:
            return
        day = F.to_date("datetime_utc")
        rows = batch.where("datetime_utc is not null").withColumn("date", day)
        late = F.lit(False)
        if before.high is not None:
            late = (F.date_add("date", 1).cast("timestamp_ntz")) <= F.lit(before.high - self.delay).cast("timestamp_ntz")
        # One row; the days of a micro-batch are few.
        seen = rows.agg(
            F.count_if(late).alias("late"),
            F.max("datetime_utc").alias("high"),
            F.collect_set(F.when(~late, F.col("date"))).alias("days"),
        ).first()
        if seen["days"]:
            slot = f"{self.path}/merged"
            if not self._is_merged(slot, number):
                merged = self._merged(rows.where(~late), sorted(seen["days"]))
                merged.withColumn("number", F.lit(number).cast("long")).write.mode("overwrite").parquet(slot)
            days = self.spark.read.parquet(slot).drop("number")
            writer = days.hint("rebalance", "date").write.mode("overwrite").partitionBy("date")
            writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/days")
        high = max(filter(None, (before.high, seen["high"])), default=None)
        after = self.spark.createDataFrame([(number, high, before.late + seen["late"])], _PROGRESS)
        after.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/progress/turn={number % 2}")

    def _is_merged(self, slot: str, number: int) -> bool:
        """Whether an earlier run of this micro-batch got as far as its merged days."""
        if not exists(self.spark, f"{slot}/_SUCCESS"):
            return False
        first = self.spark.read.parquet(slot).select("number").first()
        return first is not None and first["number"] == number

    def _stored(self, days: list[dt.date], kinds: T.StructType) -> DataFrame | None:
        held = set(child_names(self.spark, f"{self.path}/days"))
        folders = [f"{self.path}/days/date={day}" for day in days if f"date={day}" in held]
        if not folders:
            return None
        schema = T.StructType([*kinds, T.StructField("hours", T.IntegerType())]).add("counts", T._parse_datatype_string(_COUNTS))
        return self.spark.read.schema(schema.add("date", "date")).option("basePath", f"{self.path}/days").parquet(*folders)

    def _merged(self, rows: DataFrame, days: list[dt.date]) -> DataFrame:
        """State and figures of the days, stored rows and new ones together."""
        group = ["date", *self.keys]
        hour = F.expr("shiftleft(1, hour(datetime_utc))").alias("hours")
        cells = rows.select(*group, "value", hour, F.lit(1).cast("long").alias("n"))
        stored = self._stored(days, T.StructType([rows.schema[k] for k in self.keys]))
        if stored is not None:
            old = stored.select(*group, "hours", F.explode_outer("counts").alias("cell"))
            cells = cells.unionByName(
                old.select(*group, F.col("cell.value").alias("value"), "hours", F.coalesce("cell.n", F.lit(0)).alias("n"))
            )
        # Values of one day first, so that a busy sensor moves each of them once per task.
        by_value = cells.groupBy(*group, "value").agg(F.bit_or("hours").alias("hours"), F.sum("n").alias("n"))
        cell = F.when(F.col("value").isNotNull(), F.struct("value", "n"))
        state = by_value.groupBy(*group).agg(
            F.bit_or("hours").alias("hours"), F.sort_array(F.collect_list(cell)).cast(_COUNTS).alias("counts")
        )
        return state.withColumns(_figures(F.col("counts"), F.col("hours")))


def _figures(counts: Column, hours: Column) -> dict[str, Column]:
    """The figures of the batch job from sorted counts of values."""
    n = F.aggregate(counts, F.lit(0).cast("long"), lambda total, c: total + c["n"])
    total = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c["value"] * c["n"])

    def at(rank: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(None).cast("double").alias("value"))

        def step(state: Column, c: Column) -> Column:
            upto = state["upto"] + c["n"]
            found = (state["upto"] < rank) & (upto >= rank)
            return F.struct(upto.alias("upto"), F.when(found, c["value"]).otherwise(state["value"]).alias("value"))

        return F.aggregate(counts, start, step, lambda state: state["value"])

    low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    some = F.size(counts) > 0
    return {
        "value": F.when(some, total / n),
        "min": F.when(some, F.get(counts, F.lit(0))["value"]),
        "max": F.when(some, F.element_at(counts, -1)["value"]),
        "coverage_percent": F.round(F.bit_count(hours) * 100 / 24, 6),
        "n": n,
        "median": F.when(some, (at(low) + at(high)) / 2),
    }


def read_daily(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The figures of each key and day as last updated."""
    return spark.read.parquet(f"{path}/days").select("date", *keys, *FIGURES)


def _span(text: str) -> dt.timedelta:
    """``2 days`` and the like."""
    met = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text)
    if not met or met[2] not in _UNITS:
        raise ValueError(f"not a span of time: {text!r}")
    return dt.timedelta(seconds=int(met[1]) * _UNITS[met[2]])
