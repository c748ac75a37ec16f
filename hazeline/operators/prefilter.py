"""A choice of places as a filter on the scan of measurement rows.

The places are looked up first, where rows are few. What is left are sensor ids, and
rows of other sensors are cut where they are read, before any join or shuffle. Few ids
become a list in the scan's own filter, which Parquet statistics and Bloom filters can
answer. More become a bit map of hashed ids: one broadcast of a fixed size however many
they are, which lets a few other sensors pass. So the filter on places comes after the
join all the same, and this one never decides alone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.operators.filters import filter_city, filter_state
from hazeline.operators.places import UNKNOWN, Directory, fill_names

# As many ids as a list may have; they pass the driver, and each costs planning time.
LISTED = 500
# As many ids of other sensors as a broadcast may hold, some tens of megabytes.
BROADCAST_IDS = 1_000_000
# The bit map: so many words of 64 bits, some 5 MB when broadcast.
WORDS = 1 << 17

_OWN_NAME = re.compile(r"Location (-?[0-9]{1,18})")


def keep_chosen_sensors(
    rows: DataFrame,
    where: Directory,
    states: Sequence[str] = (),
    cities: Sequence[str] = (),
    listed: int | None = None,
) -> DataFrame:
    """Rows of the sensors at the chosen places, and perhaps a few others.

    A sensor the directory does not know is at the place ``Unknown``, in the city
    ``Location <its id>``. If the choice takes all of those in, rows of known sensors
    elsewhere are left out, by a list or by a broadcast of their ids; where those are
    more than BROADCAST_IDS, nothing is.
    """
    if not states and not cities:
        return rows
    listed = LISTED if listed is None else listed
    sensor = F.col("sensor_id")
    named = fill_names(where.by_sensor(stored_coords=True))
    strangers = not states or UNKNOWN in states
    if strangers and not cities:
        others = named.where(~F.col("state").isin(list(states)) & sensor.isNotNull()).select("sensor_id")
        few = _few(others, listed)
        if few is not None:
            return rows.where(sensor.isNull() | ~_listed(few)) if few else rows
        if others.limit(BROADCAST_IDS + 1).count() > BROADCAST_IDS:
            return rows
        return rows.join(F.broadcast(others), "sensor_id", "left_anti")
    chosen = filter_city(filter_state(named, states), cities)
    own = [int(m[1]) for m in map(_OWN_NAME.fullmatch, cities) if m] if strangers else []
    without_id = sensor.isNull() if strangers and UNKNOWN in cities else F.lit(False)
    few = _few(chosen, listed)
    if few is not None:
        return rows.where(_listed([*few, *own]) | without_id)
    return _in_bit_map(rows, chosen, _listed(own) | without_id)


def _listed(ids: list[int]) -> Column:
    """Whether the sensor is among these; as text, which is made faster than thousands of literals."""
    return F.expr(f"sensor_id IN ({', '.join(f'{int(i)}L' for i in ids)})") if ids else F.lit(False)


def _few(df: DataFrame, limit: int) -> list[int] | None:
    """The sensor ids of a table, or None if there are more than ``limit``."""
    found = df.where("sensor_id is not null").select("sensor_id").limit(limit + 1).collect()
    return sorted(row["sensor_id"] for row in found) if len(found) <= limit else None


def _in_bit_map(rows: DataFrame, chosen: DataFrame, others: Column) -> DataFrame:
    """Rows whose hashed sensor id is set in the bit map of the chosen ones, or that are in ``others``."""
    place = F.pmod(F.xxhash64("sensor_id"), F.lit(WORDS * 64))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    # WORDS rows at most.
    words = (
        chosen.select(place.alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("_word"))
        .agg(F.bit_or(bit).alias("_bits"))
    )
    met = rows.withColumn("_place", place).join(F.broadcast(words), F.shiftright("_place", 6) == F.col("_word"), "left")
    is_set = F.coalesce(F.getbit(F.col("_bits"), F.expr("cast(_place & 63 as int)")) == 1, F.lit(False))
    return met.where(is_set | others).drop("_place", "_word", "_bits")
