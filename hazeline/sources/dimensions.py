"""Lookup files: location names, the sensor map and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.numbers import to_id, to_number
from hazeline.operators.pick import last_per_key
from hazeline.schemas import COORDS, LOCATION, LOCATION_CSV, SENSOR_MAP, SENSOR_MAP_CSV
from hazeline.sources.files import exists, last_version

_ORDER = ["_file", "_block", "_line"]


def unique_dimension(df: DataFrame, key: str, order) -> DataFrame:
    """Rows without any missing column; of a key's rows the last stays.

    A lookup must be unique before it is joined, or it would multiply facts.
    """
    columns = df.columns if not order else [c for c in df.columns if c not in order]
    return last_per_key(df.dropna(subset=columns), [key], order or columns).select(*columns)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("header", True).option("ignoreTrailingWhiteSpace", True)
    frame = (reader.schema(schema) if schema else reader).csv(path)
    return frame.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def _read_lookup(spark, path, csv_schema, empty_schema, key, columns) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], empty_schema)
    rows = _read_csv(spark, path, csv_schema)
    picked = rows.select(*[expr.alias(name) for name, expr in columns.items()], *_ORDER)
    return unique_dimension(picked, key, _ORDER)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """``State,Code,City`` to location_id, state, city; bad codes are skipped."""
    columns = {
        "location_id": to_id(F.col("Code")),
        "state": F.col("State"),
        "city": F.col("City"),
    }
    return _read_lookup(spark, path, LOCATION_CSV, LOCATION, "location_id", columns)


def read_sensor_map(spark: SparkSession, path: str) -> DataFrame:
    """A map file, or the last version of a written map."""
    version = last_version(spark, path)
    path = f"{path}/v={version}" if version else path
    columns = {
        "sensor_id": to_id(F.col("sensor_id")),
        "location_id": to_id(F.col("location_id")),
    }
    return _read_lookup(spark, path, SENSOR_MAP_CSV, SENSOR_MAP, "sensor_id", columns)


def read_coords(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates by location; the file may have more columns, or be absent."""
    columns = {
        "location_id": to_id(F.col("location_id")),
        "latitude": to_number(F.col("latitude")),
        "longitude": to_number(F.col("longitude")),
    }
    return _read_lookup(spark, path, None, COORDS, "location_id", columns)
