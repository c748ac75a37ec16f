"""Streams: ingest, dedup, marks, alerts and daily summaries.

Event time is a timestamp with zone here, as watermarks need one; the session
zone is UTC, so it shows the same clock as the tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hazeline.operators.filters import filter_threshold
from hazeline.operators.merge import latest_per_sensor, upsert_signal
from hazeline.plans.ingest import ingest_batch
from hazeline.plans.reports import EXTREME_FROM
from hazeline.schemas import KEY
from hazeline.sources.landing import SCHEDULED
from hazeline.sources.tables import FactTable, SnapshotTable
from hazeline.streaming import daily
from hazeline.streaming.daily import DailySink


def start_ingest(
    spark: SparkSession,
    pages: DataFrame,
    facts: FactTable,
    stage: str,
    checkpoint: str,
    source: str,
    sensors: DataFrame | None = None,
    coords: DataFrame | None = None,
    flavour: str = SCHEDULED,
    start=None,
    end=None,
    as_of: dt.datetime | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Insert-ignore each micro-batch of pages.

    Without ``every`` it stops when all that has landed is in; with it, say
    ``"10 minutes"``, it goes on looking.

    ``source`` and the micro-batch number name the stored batch, so one that
    runs again after a failure replaces itself. Streams into one table need
    names of their own; a name that goes with a new checkpoint is refused by
    the table, as its batches held other files.
    """

    def merge(batch_pages: DataFrame, number: int) -> None:
        ingest_batch(
            spark,
            batch_pages,
            facts,
            f"{source}-{number:010d}",
            stage,
            sensors,
            coords,
            flavour,
            start,
            end,
            as_of,
        )

    return _writer(pages, checkpoint, every).foreachBatch(merge).start()


def start_signal(
    rows: DataFrame, signal: SnapshotTable, checkpoint: str, as_of: dt.datetime
) -> StreamingQuery:
    """Keep the latest time per sensor as each micro-batch arrives.

    Files of a stream may come out of order, so here a mark only moves on;
    that also makes a repeated micro-batch harmless.
    """

    def advance(batch: DataFrame, number: int) -> None:
        latest = latest_per_sensor(batch)
        signal.replace(upsert_signal(signal.read(), latest, as_of, forward_only=True))

    return _writer(rows, checkpoint).foreachBatch(advance).start()


def with_event_time(rows: DataFrame, column: str = "datetime_utc") -> DataFrame:
    return rows.withColumn("event_time", F.col(column).cast("timestamp"))


def dedup_stream(rows: DataFrame, delay: str = "2 days") -> DataFrame:
    """Drop repeated keys with state bounded by the watermark.

    The time is part of the key, or real later rows would go too. Which of
    several equal keys stays is open; the insert-ignore comes after.
    """
    return with_event_time(rows).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        KEY
    )


def first_stream(
    rows: DataFrame, arrival: list[str], delay: str = "2 days", keys: list[str] = KEY
) -> DataFrame:
    """The first row to arrive of each key, as the batch dedup has it, whatever order rows come in.

    A key is settled, and put out once, when the watermark has passed its time; rows that
    come later are left out. State is one row for each open key. Keys within ``delay`` of the
    latest time stay open until a later time comes; a source that may fall silent sends
    rows without a sensor (``heartbeat``) to move time on, which are not put out.
    """
    others = [c for c in rows.columns if c not in keys]
    timed = with_event_time(rows).withWatermark("event_time", delay)
    group = ["event_time", *[k for k in keys if k != "datetime_utc"]]
    # Told by an aggregate, as a filter on a key would sink below the watermark and take beats with it.
    real = F.max(F.col("sensor_id").isNotNull()).alias("real")
    first = timed.groupBy(*group).agg(F.min_by(F.struct(*others), F.struct(*arrival)).alias("first"), real)
    settled = first.where("real").withColumn("datetime_utc", F.col("event_time").cast("timestamp_ntz"))
    return settled.select(*[F.col(f"first.{c}") if c in others else F.col(c) for c in rows.columns])


def heartbeat(spark: SparkSession, stamp: dt.datetime, schema) -> DataFrame:
    """One row that holds a time and nothing else."""
    return spark.createDataFrame([(stamp,)], "datetime_utc timestamp_ntz").select(
        *[(F.col(f.name) if f.name == "datetime_utc" else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def alerts(rows: DataFrame, threshold: float = EXTREME_FROM) -> DataFrame:
    return filter_threshold(rows, threshold)


DAILY_KEYS = ("sensor_id", "parameter")


def daily_stream(rows: DataFrame, delay: str = "2 days", keys=DAILY_KEYS) -> DataFrame:
    """Closed days by key, for sinks that only append. Rows later than ``delay`` are left out.

    The median is the approximate one, whose state is bounded; ``start_daily`` has the exact one.
    """
    day = F.window("event_time", "1 day")
    watermarked = with_event_time(rows).withWatermark("event_time", delay)
    closed = watermarked.groupBy(day, *keys).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", 0.5).alias("median_approx"),
    )
    start = F.to_date(F.col("window.start"))
    return closed.select(
        start.alias("date"), *keys, "n", "mean", "min", "max", "median_approx"
    )


_SINKS: dict[str, tuple[DailySink, int]] = {}


def start_daily(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "2 days",
    keys=DAILY_KEYS,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the daily figures below ``path`` up to date, open days included.

    They are those of the batch job, exact median and coverage too. Each micro-batch
    rewrites the days it touches.
    """
    sink = DailySink(rows.sparkSession, path, keys, delay)
    before = sink.progress().late
    query = _writer(rows, checkpoint, every).foreachBatch(sink.update).start()
    _SINKS[str(query.id)] = sink, before
    return query


def read_daily(spark: SparkSession, path: str, keys=DAILY_KEYS) -> DataFrame:
    """The figures of each key and day as last updated."""
    return daily.read_daily(spark, path, keys)


def late_rows(query: StreamingQuery) -> int:
    """Rows a run left out as later than the delay allows.

    Daily figures count them in their own table, each row once, however many micro-batches
    there were. For other streams it is what Spark's last progress reports tell, where rows
    of one key and task that come together count once.
    """
    if str(query.id) in _SINKS:
        sink, before = _SINKS[str(query.id)]
        return sink.progress().late - before
    return sum(
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )


def start_to_parquet(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a stream to a Parquet folder; its sink log makes that exact."""
    writer = _writer(rows, checkpoint, every).format("parquet").outputMode("append")
    return writer.option("path", path).start()


def _writer(rows: DataFrame, checkpoint: str, every: str | None = None):
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)
