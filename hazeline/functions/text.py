"""Parameter names and the small comma-separated lists jobs take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.numbers import to_id


def is_pm25(name: Column) -> Column:
    """Exact match but for case; a missing name is no match."""
    return F.coalesce(F.lower(name) == "pm25", F.lit(False))


def looks_like_pm25(name: Column) -> Column:
    """Loose match: dots and underscores are ignored, ``pm2`` is enough."""
    return F.coalesce(F.translate(F.lower(name), "._", "").contains("pm2"), F.lit(False))


def _tokens(spark: SparkSession, text: str) -> DataFrame:
    parts = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("pos", "token"))
    return parts.select("pos", F.trim("token").alias("token")).where("token <> ''")


def location_list(spark: SparkSession, text: str) -> DataFrame:
    """``"1671, 564"`` to rows of location_id; a bad token fails the job."""
    message = F.concat(F.lit("not a location id: "), F.col("token"))
    located = F.col("token").try_cast("bigint")
    return (
        _tokens(spark, text)
        .select(F.coalesce(located, F.raise_error(message).cast("bigint")).alias("location_id"))
        .distinct()
    )


def region_overrides(spark: SparkSession, text: str) -> DataFrame:
    """``"12:West, 30:North"`` to rows; bad tokens are skipped, the last wins."""
    at = F.position(F.lit(":"), F.col("token"))
    return (
        _tokens(spark, text)
        .where(at > 0)
        .select(
            "pos",
            to_id(F.substr("token", F.lit(1), at - 1)).alias("sensor_id"),
            F.trim(F.substr(F.col("token"), at + 1)).alias("region_override"),
        )
        .where("sensor_id is not null")
        .groupBy("sensor_id")
        .agg(F.max_by("region_override", "pos").alias("region_override"))
    )
