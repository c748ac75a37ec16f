"""Landed JSON: measurement pages, location pages and sensor records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.numbers import to_id, to_number
from hazeline.functions.text import is_pm25
from hazeline.schemas import CORRUPT, FACT, LOCATION_PAGE, MEASUREMENT_PAGE, SENSOR_PAGE, require

# Arrival order of a row: file, block of the file, line in the block, place in
# the page. Rows of one block are numbered as read, so the order does not hang
# on how blocks were spread over tasks.
ARRIVAL = ["arrival_file", "arrival_block", "arrival_line", "arrival_pos"]

SCHEDULED = "scheduled"
BACKFILL = "backfill"


def _with_origin(pages: DataFrame) -> DataFrame:
    return pages.select(
        "*",
        F.col("_metadata.file_path").alias("arrival_file"),
        F.col("_metadata.file_block_start").alias("arrival_block"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages as landed, one JSON object per line; a broken line stays as text."""
    reader = spark.read.schema(MEASUREMENT_PAGE).option("columnNameOfCorruptRecord", CORRUPT)
    return _with_origin(reader.option("mode", "PERMISSIVE").json(path))


def read_page_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(MEASUREMENT_PAGE).option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files_per_trigger)
    return _with_origin(reader.json(path))


def flatten_pages(pages: DataFrame, flavour: str = SCHEDULED) -> DataFrame:
    """One row per measurement, still as text, with its arrival order.

    The scheduled flavour names every parameter ``pm25``, as the sensors were
    chosen for it; the backfill takes the record's own name. A broken line
    comes out as one row without keys. A page without results gives no row.
    """
    require(pages, ["results", CORRUPT], "page frame")
    lines = pages.withColumn("arrival_line", F.monotonically_increasing_id())
    rows = lines.where(F.col(CORRUPT).isNotNull() | (F.size("results") > 0)).select(
        "sensor_id",
        "location_id",
        CORRUPT,
        *ARRIVAL[:3],
        F.posexplode_outer("results").alias("arrival_pos", "r"),
    )
    name = F.lit("pm25") if flavour == SCHEDULED else F.col("r.parameter.name")
    return rows.select(
        "sensor_id",
        F.when(F.col(CORRUPT).isNull(), name).alias("parameter"),
        F.col("r.period.datetime_from.utc").alias("datetime_utc"),
        F.col("r.period.datetime_from.local").alias("datetime_local"),
        F.col("r.value").alias("value"),
        F.col("r.parameter.units").alias("units"),
        F.col("r.coverage.percent_complete").alias("coverage_percent"),
        F.col("r.summary.min").alias("min"),
        F.col("r.summary.max").alias("max"),
        F.col("r.summary.median").alias("median"),
        F.col("r.coordinates.latitude").alias("latitude"),
        F.col("r.coordinates.longitude").alias("longitude"),
        to_id(F.col("location_id")).alias("location_id"),
        CORRUPT,
        *ARRIVAL,
    )


def read_measurement_pages(spark: SparkSession, path: str, flavour: str = SCHEDULED) -> DataFrame:
    """The twelve measurement columns of all intact pages below a path."""
    rows = flatten_pages(read_pages(spark, path), flavour)
    return rows.where(F.col(CORRUPT).isNull()).select(*FACT.names, "location_id", *ARRIVAL)


def _read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return _with_origin(reader.option("mode", "PERMISSIVE").json(path))


def read_location_pages(spark: SparkSession, path: str) -> DataFrame:
    """Location pages, one JSON object per line; a broken line stays as text."""
    return _read_json(spark, path, LOCATION_PAGE)


def read_sensor_pages(spark: SparkSession, path: str) -> DataFrame:
    """Sensor records, one JSON object per line; a broken line stays as text."""
    return _read_json(spark, path, SENSOR_PAGE)


def broken_lines(pages: DataFrame) -> DataFrame:
    """The lines of location or sensor pages that could not be read, or have no id."""
    unread = F.col(CORRUPT).isNotNull() | to_id(F.col("id")).isNull()
    return pages.where(unread).select(*[c for c in ARRIVAL if c in pages.columns], "id", CORRUPT)


def location_sensors(locations: DataFrame, only_pm25: bool = True) -> DataFrame:
    """One row per sensor of each location, with its arrival order.

    Locations without sensors vanish, and so do broken lines, which
    ``broken_lines`` has.
    """
    lines = locations.withColumn("arrival_line", F.monotonically_increasing_id())
    order = [c for c in ARRIVAL[:3] if c in lines.columns]
    rows = lines.select(
        to_id(F.col("id")).alias("location_id"),
        *order,
        F.posexplode("sensors").alias("arrival_pos", "s"),
    )
    rows = rows.select(
        "location_id",
        to_id(F.col("s.id")).alias("sensor_id"),
        F.col("s.name").alias("sensor_name"),
        F.col("s.parameter.name").alias("parameter"),
        to_number(F.col("s.coordinates.latitude")).alias("latitude"),
        to_number(F.col("s.coordinates.longitude")).alias("longitude"),
        *order,
        "arrival_pos",
    ).where("location_id is not null and sensor_id is not null")
    return rows.where(is_pm25(F.col("parameter"))) if only_pm25 else rows
