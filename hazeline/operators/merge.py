"""Merges: insert-ignore for facts, upserts for metadata and marks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.operators.cleaning import dedup_first
from hazeline.schemas import KEY, require


def accepted_rows(stored: DataFrame, batch: DataFrame, arrival, keys=None) -> DataFrame:
    """Batch rows an insert-ignore would add.

    The first row of each key in the batch, unless the key is stored. Dedup
    and anti join share one hash partitioning of the batch, and after the
    dedup each key occurs once per side, so no key is hot.
    """
    keys = keys or KEY
    return new_rows(stored, dedup_first(batch, arrival, keys), keys)


def new_rows(stored: DataFrame, distinct_batch: DataFrame, keys=None) -> DataFrame:
    keys = keys or KEY
    require(stored, keys, "stored table")
    return distinct_batch.join(stored.select(*keys), keys, "left_anti")


def marked_rows(
    stored: DataFrame, batch: DataFrame, arrival, keys=None, parts: int | None = None
) -> DataFrame:
    """The first batch row of each key, with ``stored``: whether the table has the key.

    The batch's keys are shuffled once, for the dedup and for the join. A stored table
    that is bucketed by the keys into ``parts`` is not shuffled at all: the batch's first
    rows are dealt to its buckets, and the result is dealt like the table.
    """
    keys = keys or KEY
    require(stored, keys, "stored table")
    known = stored.select(*keys).dropDuplicates(keys).withColumn("stored", F.lit(True))
    first = dedup_first(batch, arrival, keys)
    if parts is not None:
        first, known = first.repartition(parts, *keys), known.hint("merge")
    marked = first.join(known, keys, "left")
    return marked.withColumn("stored", F.col("stored").isNotNull())


def insert_ignore(stored: DataFrame, batch: DataFrame, arrival, keys=None) -> DataFrame:
    """Stored rows and accepted rows. A stored row is never corrected."""
    return stored.unionByName(accepted_rows(stored, batch, arrival, keys).select(*stored.columns))


def ingest_stats(stored: DataFrame, batch: DataFrame, keys=None) -> DataFrame:
    """One row: attempted (after in-batch dedup), inserted, duplicates."""
    keys = keys or KEY
    # One shuffle of keys, cut to one row per key and task beforehand.
    sides = stored.select(*keys, F.lit(True).alias("stored")).unionByName(
        batch.select(*keys, F.lit(False).alias("stored"))
    )
    by_key = sides.groupBy(*keys).agg(
        F.max("stored").alias("known"), F.min("stored").alias("only_stored")
    )
    return by_key.where(~F.col("only_stored")).agg(
        F.count(F.lit(1)).alias("attempted"),
        F.count_if(~F.col("known")).alias("inserted"),
        F.count_if(F.col("known")).alias("duplicates"),
    )


def upsert_metadata(
    stored: DataFrame, batch: DataFrame, as_of: dt.datetime, arrival: str | None = None
) -> DataFrame:
    """New snapshot of the sensor metadata.

    Name, parameter and region follow the batch even where it says nothing.
    Coordinates and last_seen keep the stored value if the batch has none. If
    a sensor occurs several times in the batch, its rows apply in ``arrival``
    order.
    """
    if arrival is not None:
        kept = ["latitude", "longitude", "last_seen"]
        batch = batch.groupBy("sensor_id").agg(
            *[
                F.max_by(c, F.col(arrival)).alias(c)
                for c in ("sensor_name", "parameter", "region")
            ],
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(arrival))).alias(c) for c in kept],
        )
    old, new = stored.alias("old"), batch.withColumn("in_batch", F.lit(True)).alias("new")
    both = old.join(new, "sensor_id", "full")
    updated = F.col("new.in_batch").isNotNull()

    def overwritten(name):
        return F.when(updated, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    def filled(name):
        return F.coalesce(F.col(f"new.{name}"), F.col(f"old.{name}")).alias(name)

    return both.select(
        "sensor_id",
        overwritten("sensor_name"),
        overwritten("parameter"),
        filled("latitude"),
        filled("longitude"),
        overwritten("region"),
        filled("last_seen"),
        F.when(updated, F.lit(as_of).cast("timestamp"))
        .otherwise(F.col("old.updated_at"))
        .alias("updated_at"),
    )


def latest_per_sensor(df: DataFrame) -> DataFrame:
    return df.groupBy("sensor_id").agg(F.max("datetime_utc").alias("last_data_datetime_utc"))


def upsert_signal(
    stored: DataFrame, latest: DataFrame, as_of: dt.datetime, forward_only: bool = False
) -> DataFrame:
    """New snapshot of the marks.

    A mark is overwritten even if it moves backwards, unless ``forward_only``.
    """
    old, new = stored.alias("old"), latest.withColumn("in_batch", F.lit(True)).alias("new")
    updated = F.col("new.in_batch").isNotNull()
    mark = "last_data_datetime_utc"
    old_mark, new_mark = F.col(f"old.{mark}"), F.col(f"new.{mark}")
    if forward_only:
        new_mark = F.greatest(new_mark, old_mark)
    return old.join(new, "sensor_id", "full").select(
        "sensor_id",
        F.when(updated, new_mark).otherwise(old_mark).alias(mark),
        F.when(updated, F.lit(as_of).cast("timestamp"))
        .otherwise(F.col("old.last_run_time"))
        .alias("last_run_time"),
    )


def signal_windows(signal: DataFrame, sensors: DataFrame, default_start: dt.datetime) -> DataFrame:
    """Where to start reading for each requested sensor.

    The mark is inclusive: its row comes again and the insert-ignore drops it.
    """
    requested = sensors.select("sensor_id").distinct()
    marks = signal.select("sensor_id", "last_data_datetime_utc")
    start = F.coalesce(
        F.col("last_data_datetime_utc"), F.lit(default_start).cast("timestamp_ntz")
    )
    return requested.join(marks, "sensor_id", "left").select("sensor_id", start.alias("start"))
