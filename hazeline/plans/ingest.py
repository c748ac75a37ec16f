"""Batch ingest: landed pages to the fact table, and what a run reports."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.dates import utc_clock
from hazeline.functions.numbers import to_id, to_number
from hazeline.operators.cleaning import in_range, is_unstorable, prepare_measurements
from hazeline.operators.filters import filter_locations
from hazeline.operators.merge import marked_rows
from hazeline.operators.places import assign_region, coords_by_priority
from hazeline.operators.sizing import keep_listed, lookup_join
from hazeline.schemas import CORRUPT, FACT, LOCATED_SENSOR, STAGED, require
from hazeline.sources.exports import build_sensor_map, write_sensor_map
from hazeline.sources.landing import (
    ARRIVAL,
    BACKFILL,
    SCHEDULED,
    flatten_pages,
    location_sensors,
    read_pages,
)
from hazeline.sources.tables import FactTable, month_ranges

OK, BAD = "ok", "bad"

# Fixed value: where a run starts reading unless told otherwise.
DEFAULT_START = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class IngestStats:
    attempted: int
    inserted: int
    duplicates: int
    quarantined: int


def sensor_coords(
    sensors: DataFrame, coords: DataFrame | None, order: list[str] = ARRIVAL
) -> DataFrame:
    """One row per sensor with the coordinates its measurements get.

    Location and own coordinates are those of the record listed last, taken
    together. The lookup goes by location and, where it has the location, counts
    before the sensor's own coordinates.
    """
    require(sensors, order, "listed sensors")
    listed = F.struct(
        "location_id", F.col("latitude").alias("own_latitude"), F.col("longitude").alias("own_longitude")
    )
    known = sensors.groupBy("sensor_id").agg(F.max_by(listed, F.struct(*order)).alias("last"))
    known = known.select("sensor_id", "last.*")
    if coords is None:
        located = known.withColumnsRenamed({"own_latitude": "lat", "own_longitude": "lon"})
    else:
        lat, lon = coords_by_priority(
            (F.col("latitude"), F.col("longitude")),
            (F.col("own_latitude"), F.col("own_longitude")),
        )
        joined = lookup_join(known, coords, "location_id", ["sensor_id"])
        located = joined.withColumns({"lat": lat, "lon": lon})
    return located.select("sensor_id", "location_id", "lat", "lon")


def with_coords(
    rows: DataFrame,
    sensors: DataFrame,
    flavour: str = SCHEDULED,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Rows with ``known`` and, for known sensors, their coordinates.

    The scheduled flavour falls back on what the measurement itself says; the
    backfill does not.
    """
    found = sensors.select("sensor_id", "lat", "lon", F.lit(True).alias("known"))
    joined = lookup_join(rows, found, "sensor_id", spread_by or ARRIVAL)
    own = (F.col("lat"), F.col("lon"))
    if flavour == BACKFILL:
        lat, lon = own
    else:
        lat, lon = coords_by_priority(own, (F.col("latitude"), F.col("longitude")))
    return joined.withColumns({"latitude": lat, "longitude": lon}).drop("lat", "lon")


def clean_pages(pages: DataFrame, flavour: str = SCHEDULED, start=None, end=None) -> DataFrame:
    """Pages to typed rows with a ``status``; rows out of range are gone.

    Broken lines and rows without a key get status bad, for the quarantine.
    """
    rows = prepare_measurements(flatten_pages(pages, flavour))
    bad = is_unstorable(rows) | F.col(CORRUPT).isNotNull()
    rows = rows.withColumn("status", F.when(bad, F.lit(BAD)).otherwise(F.lit(OK)))
    kept = (F.col("status") == BAD) | in_range(F.col("datetime_utc"), start, end)
    return rows.where(kept).select(*FACT.names, "location_id", CORRUPT, *ARRIVAL, "status")


def ingest_batch(
    spark: SparkSession,
    pages: DataFrame,
    facts: FactTable,
    batch: str,
    stage: str,
    sensors: DataFrame | None = None,
    coords: DataFrame | None = None,
    flavour: str = SCHEDULED,
    start=None,
    end=None,
    as_of: dt.datetime | None = None,
) -> IngestStats:
    """Land to table: flatten, clean, locate, dedup, insert-ignore.

    The cleaned batch is staged as a table first, one pass without a shuffle.
    From there on everything reads columns instead of JSON, and the months and
    times the batch touches are known: only stored keys between them are read
    for the merge, where they lie, and only the batch is shuffled. The tasks that
    write accepted rows also count them and the duplicates; those counts are part of
    a task's result, so they are exact even if tasks ran twice, and nothing is read
    again for them. A batch is known by the files it was made of:
    running it again replaces what it put in, and other files under its name are
    refused before anything is written. With ``sensors`` only their rows go in;
    the sensors are staged too, as several jobs read them. The staged folder
    keeps the unusable rows under ``status=bad``.
    """
    source = source_of(pages)
    facts.claim(batch, source)
    seen = Observation()
    cleaned = clean_pages(pages, flavour, start, end).observe(
        seen,
        F.count_if(F.col("status") == BAD).alias("bad"),
        F.collect_set(F.when(F.col("status") == OK, F.date_format("datetime_utc", "yyyy-MM-dd"))).alias("days"),
    )
    cleaned.write.mode("overwrite").partitionBy("status").parquet(f"{stage}/batch={batch}")
    good = staged_rows(spark, stage, batch)
    quarantined = seen.get["bad"]
    touched = month_ranges([dt.date.fromisoformat(day) for day in seen.get["days"]])

    if sensors is not None:
        located = f"{stage}/sensors/batch={batch}"
        sensor_coords(sensors, coords).write.mode("overwrite").parquet(located)
        known = spark.read.schema(LOCATED_SENSOR).parquet(located)
        good = with_coords(good, known, flavour).where("known")
    met = Observation()
    with facts.dealt(touched, skip_batch=batch) as stored:
        marked = marked_rows(stored, good, ARRIVAL, parts=facts.buckets)
        marked = marked.observe(met, F.count_if("stored").alias("duplicates"))
        inserted = facts.append(marked.where("not stored"), batch, source, as_of, dealt=True)
    duplicates = met.get["duplicates"]
    return IngestStats(inserted + duplicates, inserted, duplicates, quarantined)


def source_of(pages: DataFrame) -> str:
    """A digest of the names of the files that pages were read from.

    Spark knows them without a job, but for a micro-batch, whose files are few.
    """
    files = pages.inputFiles()
    if not files and "arrival_file" in pages.columns:
        files = [row["arrival_file"] for row in pages.select("arrival_file").distinct().collect()]
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def staged_rows(
    spark: SparkSession, stage: str, batch: str, status: str | None = OK
) -> DataFrame:
    """Cleaned rows of a batch as staged, before dedup; of any status if None."""
    rows = spark.read.schema(STAGED).parquet(f"{stage}/batch={batch}")
    return rows if status is None else rows.where(F.col("status") == status)


def scheduled_run(
    spark: SparkSession,
    landing: str,
    locations: DataFrame,
    requested: DataFrame,
    coords: DataFrame | None,
    facts: FactTable,
    batch: str,
    stage: str,
    start=DEFAULT_START,
    end=None,
    map_path: str | None = None,
    as_of: dt.datetime | None = None,
    merge_map: bool = False,
) -> IngestStats:
    """The daily job: everything landed for the requested locations."""
    sensors = requested_sensors(locations, requested)
    if map_path is not None:
        write_sensor_map(build_sensor_map(sensors), map_path, merge_map)
    pages = read_pages(spark, landing)
    return ingest_batch(
        spark, pages, facts, batch, stage, sensors, coords, SCHEDULED, start, end, as_of
    )


def backfill_run(
    spark: SparkSession,
    landing: str,
    locations: DataFrame,
    requested: DataFrame,
    coords: DataFrame | None,
    facts: FactTable,
    batch: str,
    stage: str,
    start=DEFAULT_START,
    end=None,
    map_path: str | None = None,
    as_of: dt.datetime | None = None,
    merge_map: bool = False,
) -> DataFrame:
    """The manual job over a date range; returns its summary row."""
    sensors = requested_sensors(locations, requested)
    if map_path is not None:
        write_sensor_map(build_sensor_map(sensors), map_path, merge_map)
    pages = read_pages(spark, landing)
    stats = ingest_batch(
        spark, pages, facts, batch, stage, sensors, coords, BACKFILL, start, end, as_of
    )
    return run_summary(requested, sensors, staged_rows(spark, stage, batch), stats)


def requested_sensors(locations: DataFrame, requested: DataFrame) -> DataFrame:
    """Matching sensors of the location pages that were asked for."""
    return filter_locations(location_sensors(locations), requested)


def sensor_metadata_records(pages: DataFrame, overrides: DataFrame) -> DataFrame:
    """Sensor records to metadata rows, with region; broken lines are left out.

    ``landing.broken_lines`` has those.
    """
    rows = pages.select(
        to_id(F.col("id")).alias("sensor_id"),
        F.col("name").alias("sensor_name"),
        F.col("parameter.name").alias("parameter"),
        to_number(F.col("latest.coordinates.latitude")).alias("latitude"),
        to_number(F.col("latest.coordinates.longitude")).alias("longitude"),
        utc_clock(F.col("datetime_last.utc")).alias("last_seen"),
    ).where("sensor_id is not null")
    return assign_region(rows, overrides).select(
        "sensor_id", "sensor_name", "parameter", "latitude", "longitude", "region", "last_seen"
    )


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)


def run_summary(
    requested: DataFrame,
    sensors: DataFrame,
    measured: DataFrame,
    stats: IngestStats | None = None,
) -> DataFrame:
    """One row on a run: what was found, what failed, what was skipped.

    ``requested`` are the location ids asked for, ``sensors`` the matching
    sensors found, ``measured`` the rows in range, before dedup. A location
    without a matching sensor is skipped; a sensor without a row has failed.
    """
    asked = requested.select("location_id").distinct()
    found = sensors.select("location_id", "sensor_id").distinct()
    found = keep_listed(found, asked, "location_id")
    with_rows = measured.select("sensor_id").distinct().withColumn("has_rows", F.lit(True))
    has_rows = F.col("has_rows").isNotNull()
    of_sensors = found.join(with_rows, "sensor_id", "left").agg(
        F.count_if(has_rows).alias("successful_sensors"),
        F.count_if(~has_rows).alias("failed_sensors"),
        F.countDistinct("location_id").alias("located"),
        F.countDistinct("sensor_id").alias("sensor_mappings"),
    )
    of_locations = asked.agg(F.count(F.lit(1)).alias("total_locations"))
    # Two rows, each with the other's columns empty.
    both = of_sensors.unionByName(of_locations, allowMissingColumns=True)
    summary = both.agg(*[F.sum(c).alias(c) for c in both.columns]).select(
        "successful_sensors",
        "failed_sensors",
        (F.col("total_locations") - F.col("located")).alias("skipped_locations"),
        "total_locations",
        "sensor_mappings",
    )
    if stats is None:
        return summary
    return summary.withColumns(
        {
            "total_rows_attempted": F.lit(stats.attempted),
            "total_rows_inserted": F.lit(stats.inserted),
            "total_duplicates": F.lit(stats.duplicates),
        }
    )
