"""Where a sensor is: location, state, city, coordinates and region."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.operators.sizing import lookup_join

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Directory:
    """The lookups a place is found by, each unique by its id.

    ``sensor_map`` has sensor_id and location_id, ``locations`` location_id,
    state and city, ``coords`` location_id, latitude and longitude.
    """

    sensor_map: DataFrame
    locations: DataFrame
    coords: DataFrame | None = None

    def by_sensor(self, stored_coords: bool) -> DataFrame:
        """One row per sensor id that is in the map, or stands for a location itself.

        The lookups meet here, where rows are few, so that measurement rows meet one
        table. A sensor that is not in the map is looked up by its own id as if that
        were a location. Coordinates stored with the rows win, and then none come.
        """
        mapped = self.sensor_map.select("sensor_id", "location_id", F.lit(False).alias("is_fallback"))
        named = self.locations.select("location_id", "state", "city")
        ids = named.select("location_id")
        spots = None
        if self.coords is not None and not stored_coords:
            spots = self.coords.select("location_id", "latitude", "longitude")
            ids = ids.union(spots.select("location_id"))
        own = ids.distinct().select(
            F.col("location_id").alias("sensor_id"), "location_id", F.lit(True).alias("is_fallback")
        )
        found = mapped.union(own.join(mapped, "sensor_id", "left_anti")).join(named, "location_id", "left")
        return found if spots is None else found.join(spots, "location_id", "left")


def _attach(df: DataFrame, where: Directory, join) -> DataFrame:
    """Join the directory and fill what it does not know."""
    return fill_names(join(df, where.by_sensor("latitude" in df.columns)))


def fill_names(df: DataFrame) -> DataFrame:
    """Names for rows that met the directory, or for the directory itself."""
    state = F.coalesce(F.col("state"), F.lit(UNKNOWN))
    location_id = F.coalesce(F.col("location_id"), F.col("sensor_id"))
    unnamed = F.concat(F.lit("Location "), location_id.cast("string"))
    # Never null, so that joins on it put no filter below shared partials.
    city = F.coalesce(F.col("city"), unnamed, F.lit(UNKNOWN))
    full = F.concat_ws(", ", city, state)
    return df.withColumns(
        {
            "is_fallback": F.coalesce("is_fallback", F.lit(True)),
            "location_id": location_id,
            "state": state,
            "city": city,
            "location_name": F.when(state != UNKNOWN, full).otherwise(city),
        }
    )


def attach_to_sensors(df: DataFrame, where: Directory) -> DataFrame:
    """Places for rows already reduced to a few per sensor.

    These come out of a group-by on sensor_id, so there is little left to
    move and no key is hot; the planner chooses the join.
    """
    return _attach(df, where, lambda rows, directory: rows.join(directory, "sensor_id", "left"))


def enrich(df: DataFrame, where: Directory) -> DataFrame:
    """Places for every measurement row, and the UTC date, by one join.

    The directory is broadcast if its measured size allows; if not, rows of
    frequent sensors are spread by time.
    """

    def join(rows, directory):
        return lookup_join(rows, directory, "sensor_id", ["sensor_id", "datetime_utc"])

    return _attach(df, where, join).withColumn("date", F.to_date("datetime_utc"))


def coords_by_priority(*pairs: tuple[Column, Column]) -> tuple[Column, Column]:
    """Latitude and longitude from the first source that has each of them."""
    return F.coalesce(*[p[0] for p in pairs]), F.coalesce(*[p[1] for p in pairs])


def region_of(longitude: Column, override: Column) -> Column:
    """Region by longitude; an override wins even where longitude is missing."""
    # Where regions begin.
    by_longitude = (
        F.when(longitude.isNull(), F.lit(UNKNOWN))
        .when(longitude <= -105, F.lit("West"))
        .when(longitude <= -90, F.lit("Midwest"))
        .otherwise(F.lit("East"))
    )
    return F.coalesce(override, by_longitude)


def assign_region(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """Add ``region`` to rows with sensor_id and longitude."""
    joined = df.join(overrides, "sensor_id", "left")
    region = region_of(F.col("longitude"), F.col("region_override"))
    return joined.withColumn("region", region).drop("region_override")
