"""Lookups, regions and filters on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.operators import filters, sizing
from hazeline.operators.places import Directory, assign_region, attach_to_sensors, enrich
from hazeline.operators.sizing import lookup_join
from hazeline.plans.ingest import sensor_coords, with_coords

STAMP = dt.datetime(2024, 1, 6, 23, 30)


@pytest.fixture
def where(spark):
    return Directory(
        spark.createDataFrame([(1, 100), (2, 200), (3, 999)], "sensor_id long, location_id long"),
        spark.createDataFrame(
            [(100, "Ohio", "Dayton"), (200, "Texas", "Austin"), (7, "Utah", "Provo")],
            "location_id long, state string, city string",
        ),
        spark.createDataFrame(
            [(100, 39.7, -84.2), (8, 1.0, 2.0)],
            "location_id long, latitude double, longitude double",
        ),
    )


PLACES = {
    # A mapped sensor; one whose location has no name; one unmapped that hits a
    # real location by its own id; two unmapped without a name, one with a spot.
    1: (100, "Ohio", "Dayton", "Dayton, Ohio", False, 39.7),
    3: (999, "Unknown", "Location 999", "Location 999", False, None),
    7: (7, "Utah", "Provo", "Provo, Utah", True, None),
    8: (8, "Unknown", "Location 8", "Location 8", True, 1.0),
    9: (9, "Unknown", "Location 9", "Location 9", True, None),
}
COLUMNS = ["location_id", "state", "city", "location_name", "is_fallback", "latitude"]


def test_places_with_fallback(spark, where):
    rows = spark.createDataFrame(
        [(s, STAMP, 1.0) for s in PLACES], "sensor_id long, datetime_utc timestamp_ntz, value double"
    )
    for attach in (enrich, attach_to_sensors):
        found = {r["sensor_id"]: tuple(r[c] for c in COLUMNS) for r in attach(rows, where).collect()}
        assert found == PLACES
    assert enrich(rows, where).first()["date"] == dt.date(2024, 1, 6)


def test_stored_coordinates_win(spark, where):
    rows = spark.createDataFrame(
        [(1, 5.0, 6.0), (8, None, None)], "sensor_id long, latitude double, longitude double"
    )
    found = {r["sensor_id"]: r["latitude"] for r in attach_to_sensors(rows, where).collect()}
    assert found == {1: 5.0, 8: None}


def test_shuffled_lookup_equals_broadcast(spark, rows, monkeypatch):
    """A third of the rows share one key, a tenth have none."""
    monkeypatch.setattr(sizing, "HOT_ROWS", 500)
    number = F.col("id")
    facts = spark.range(9000).select(
        F.when(number % 3 == 0, 1).when(number % 10 != 1, number % 50).alias("k"), "id"
    )
    lookup = spark.range(40).select(number.alias("k"), (number * 10).alias("v"))
    small = lookup_join(facts, lookup, "k", ["id"])
    shuffled = lookup_join(facts, lookup, "k", ["id"], limit=0)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    assert small.columns == shuffled.columns
    assert rows(small, "id", "k", "v") == rows(shuffled, "id", "k", "v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    placed = shuffled.withColumn("task", F.spark_partition_id())
    counts = placed.groupBy("k", "task").count().collect()
    for hot in (1, None):
        split = [r["count"] for r in counts if r["k"] == hot]
        assert max(split) < sum(split) * 0.4
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
def test_row_level_operators_either_way(spark, where, rows, monkeypatch, limit):
    """The same rows whether lookups are broadcast or shuffled."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(sizing, "HOT_ROWS", 3)
    sensors = [1] * 6 + [3, 7, 8, 9]
    data = [(s, STAMP + dt.timedelta(hours=i), 1.0) for i, s in enumerate(sensors)]
    df = spark.createDataFrame(data, "sensor_id long, datetime_utc timestamp_ntz, value double")
    placed = enrich(df, where)
    assert rows(placed.select("sensor_id", *COLUMNS).distinct()) == sorted(
        ((s, *place) for s, place in PLACES.items()), key=lambda r: str(r[0])
    )
    assert placed.count() == len(data)
    listed = spark.createDataFrame([("Ohio",), ("Utah",), ("Ohio",)], "state string")
    assert filters.filter_state(placed, listed).count() == 7


def test_measured_bytes_follow_text(spark):
    from hazeline.operators.sizing import measured

    short = spark.createDataFrame([("a",)], "x string")
    long = spark.createDataFrame([("a" * 1000,)], "x string")
    empty = short.where("false")
    sizes = measured([short, long, empty])
    assert sizes[1][0] - sizes[0][0] == 999 and sizes[2] == (0, 0) and sizes[0][1] == 1


def test_region(spark):
    rows = spark.createDataFrame(
        [(1, -105.0), (2, -104.9), (3, -90.0), (4, -89.9), (5, None), (6, None)],
        "sensor_id long, longitude double",
    )
    overrides = spark.createDataFrame([(6, "South")], "sensor_id long, region_override string")
    found = {r["sensor_id"]: r["region"] for r in assign_region(rows, overrides).collect()}
    assert found == {
        1: "West", 2: "Midwest", 3: "Midwest", 4: "East", 5: "Unknown", 6: "South"
    }


def test_coordinate_priority(spark):
    sensors = spark.createDataFrame(
        # the last listing counts, with its own coordinates, were they smaller
        [(1, 100, 1.0, 1.5, 0), (2, 999, 20.0, -90.0, 0), (2, 200, 2.0, 2.5, 1), (3, 300, None, None, 0)],
        "sensor_id long, location_id long, latitude double, longitude double, n int",
    )
    coords = spark.createDataFrame(
        [(100, 9.0, 9.5)], "location_id long, latitude double, longitude double"
    )
    rows = spark.createDataFrame(
        [(s, 7.0, 7.5) for s in (1, 2, 3, 4)], "sensor_id long, latitude double, longitude double"
    )
    located = sensor_coords(sensors, coords, ["n"])
    for flavour, third in (("scheduled", 7.0), ("backfill", None)):
        joined = with_coords(rows, located, flavour, spread_by=["sensor_id"])
        found = {r["sensor_id"]: (r["latitude"], r["known"]) for r in joined.collect()}
        assert found[1] == (9.0, True) and found[2] == (2.0, True)
        assert found[3] == (third, True) and found[4][1] is None


@pytest.fixture
def measured(spark):
    stamps = [dt.datetime(2024, 1, d, h) for d, h in ((1, 0), (2, 23), (3, 0), (4, 12))]
    data = [(i, s, v) for i, (s, v) in enumerate(zip(stamps, (34.9, 35.0, None, float("nan"))))]
    return spark.createDataFrame(data, "sensor_id long, datetime_utc timestamp_ntz, value double")


def test_dates_are_inclusive(measured):
    def ids(*span):
        return sorted(r[0] for r in filters.filter_date(measured, *span).collect())

    assert ids(dt.date(2024, 1, 2), dt.date(2024, 1, 3)) == [1, 2]
    assert ids(None, dt.date(2024, 1, 1)) == [0]
    assert ids(dt.date(2024, 1, 4), None) == [3]
    assert ids() == [0, 1, 2, 3]


def test_threshold_never_takes_missing(spark, measured):
    from hazeline.functions.numbers import no_nan

    clean = measured.withColumn("value", no_nan(F.col("value")))
    watch = filters.filter_scenario(clean, "AQI Watch (≥35 µg/m³)")
    assert [r["sensor_id"] for r in watch.collect()] == [1]
    assert filters.filter_scenario(clean, "Base Case (All Data)").count() == 4


def test_choice_lists(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "state string, city string")
    assert filters.filter_state(df, []).count() == 3
    assert filters.filter_state(df, ["a", "c"]).count() == 2
    assert filters.filter_city(df, ["x"]).count() == 2
    listed = spark.createDataFrame([("y",)], "city string")
    assert filters.filter_city(df, listed).collect()[0]["state"] == "c"


def test_requested_locations(spark, where):
    known = filters.requested_locations(spark, None, where.locations)
    assert {r[0] for r in known.collect()} == {100, 200, 7}
    assert {r[0] for r in filters.requested_locations(spark, "5", where.locations).collect()} == {5}


PLACED_ROWS = [(i, 1.0) for i in (1, 2, 3, 7, 8, 9, 100, 5000)] + [(None, 2.0)]
CHOICES = [
    dict(states=["A"]),
    dict(states=["Unknown"]),
    dict(states=["A", "Unknown"]),
    dict(states=["nowhere"]),
    dict(cities=["x"]),
    dict(cities=["x", "Location 5000", "Location 3", "Location x"]),
    dict(states=["B"], cities=["x", "Location 5000"]),
    dict(states=["Unknown"], cities=["Unknown", "Location 9"]),
    dict(cities=["Unknown"]),
    dict(),
]


@pytest.mark.parametrize("listed", [10_000, 0])
@pytest.mark.parametrize("choice", CHOICES, ids=str)
def test_rows_are_cut_at_the_scan_and_none_is_lost(spark, choice, listed):
    """Sensors the directory does not know, and rows without a sensor, pass where the choice takes them in."""
    from hazeline.operators.places import enrich
    from hazeline.operators.prefilter import keep_chosen_sensors

    where = Directory(
        spark.createDataFrame([(1, 100), (2, 200), (3, 300), (4, 100)], "sensor_id long, location_id long"),
        spark.createDataFrame(
            [(100, "A", "x"), (200, "B", "x"), (7, "A", None), (8, None, "z")],
            "location_id long, state string, city string",
        ),
    )
    rows = spark.createDataFrame(PLACED_ROWS, "sensor_id long, value double")
    rows = rows.withColumn("datetime_utc", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))

    def chosen(df):
        placed = filters.filter_state(enrich(df, where), choice.get("states"))
        return sorted((str(r["sensor_id"]), r["state"], r["city"]) for r in filters.filter_city(placed, choice.get("cities")).collect())

    kept = keep_chosen_sensors(rows, where, **choice, listed=listed)
    assert kept.columns == rows.columns
    assert chosen(kept) == chosen(rows)
    if choice == CHOICES[0]:
        assert {r["sensor_id"] for r in kept.collect()} == {1, 7, 100}
