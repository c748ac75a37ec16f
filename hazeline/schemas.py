"""Declared schemas. Nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Numbers arrive as text so that a bad one becomes a null, not a lost page.
_COORDINATES_TEXT = T.StructType(
    [
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ]
)

_RESULT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField(
            "parameter",
            T.StructType(
                [T.StructField("name", T.StringType()), T.StructField("units", T.StringType())]
            ),
        ),
        T.StructField(
            "period",
            T.StructType(
                [
                    T.StructField(
                        "datetime_from",
                        T.StructType(
                            [
                                T.StructField("utc", T.StringType()),
                                T.StructField("local", T.StringType()),
                            ]
                        ),
                    )
                ]
            ),
        ),
        T.StructField(
            "coverage", T.StructType([T.StructField("percent_complete", T.StringType())])
        ),
        T.StructField(
            "summary",
            T.StructType(
                [
                    T.StructField("min", T.StringType()),
                    T.StructField("max", T.StringType()),
                    T.StructField("median", T.StringType()),
                ]
            ),
        ),
        T.StructField("coordinates", _COORDINATES_TEXT),
    ]
)

CORRUPT = "corrupt_line"

MEASUREMENT_PAGE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("results", T.ArrayType(_RESULT)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

LOCATION_PAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "sensors",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField(
                            "parameter", T.StructType([T.StructField("name", T.StringType())])
                        ),
                        T.StructField("coordinates", _COORDINATES_TEXT),
                    ]
                )
            ),
        ),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

SENSOR_PAGE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("parameter", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("latest", T.StructType([T.StructField("coordinates", _COORDINATES_TEXT)])),
        T.StructField("datetime_last", T.StructType([T.StructField("utc", T.StringType())])),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# Names and order of the columns of the stored tables.
KEY = ["sensor_id", "parameter", "datetime_utc"]

FACT = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("datetime_utc", T.TimestampNTZType()),
        T.StructField("datetime_local", T.TimestampNTZType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("units", T.StringType()),
        T.StructField("coverage_percent", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("median", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)

# As stored: the insert time, the batch, and the month, which is a folder.
STORED_FACT = T.StructType(
    FACT.fields
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("batch", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)

# What a write put into the fact table: a row per month, and one without month that
# keeps the batch's name, what it was made of, and how many rows it added.
MANIFEST = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("batch", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("low", T.TimestampNTZType()),
        T.StructField("high", T.TimestampNTZType()),
        T.StructField("rows", T.LongType()),
        T.StructField("compacted", T.BooleanType()),
        T.StructField("buckets", T.IntegerType()),
    ]
)

# Cleaned rows of one batch, with their arrival order.
STAGED = T.StructType(
    FACT.fields
    + [
        T.StructField("location_id", T.LongType()),
        T.StructField(CORRUPT, T.StringType()),
        T.StructField("arrival_file", T.StringType()),
        T.StructField("arrival_block", T.LongType()),
        T.StructField("arrival_line", T.LongType()),
        T.StructField("arrival_pos", T.IntegerType()),
        T.StructField("status", T.StringType()),
    ]
)

# A sensor of one run with the coordinates its rows get.
LOCATED_SENSOR = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("location_id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

SENSOR_METADATA = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("sensor_name", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

SIGNAL = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("last_data_datetime_utc", T.TimestampNTZType()),
        T.StructField("last_run_time", T.TimestampType()),
    ]
)

LOCATION_CSV = T.StructType(
    [
        T.StructField("State", T.StringType()),
        T.StructField("Code", T.StringType()),
        T.StructField("City", T.StringType()),
    ]
)

SENSOR_MAP_CSV = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("location_id", T.StringType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("city", T.StringType()),
    ]
)

SENSOR_MAP = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("location_id", T.LongType()),
    ]
)

COORDS = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


def require(df: DataFrame, columns, what: str) -> DataFrame:
    """Refuse a frame that lacks columns before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
    return df
