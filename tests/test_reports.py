"""Reports against hand-made frames, brute force and control figures."""

import datetime as dt
import re
import statistics

import pytest
from conftest import SMALL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazeline.operators import median
from hazeline.operators.median import exact_median
from hazeline.operators.places import Directory
from hazeline.plans import daily, reports
from hazeline.plans.loading import Selection, sensor_metadata
from hazeline.plans.reports import Scope
from hazeline.plans.suite import REPORTS, run_suite, with_cube
from hazeline.queries import views

SCHEMA = "sensor_id long, datetime_utc timestamp_ntz, value double, latitude double, longitude double"


def at(day, month=1, year=2024, hour=5):
    return dt.datetime(year, month, day, hour)


def directory(spark, sensors, locations):
    return Directory(
        spark.createDataFrame(sensors, "sensor_id long, location_id long"),
        spark.createDataFrame(locations, "location_id long, state string, city string"),
    )


@pytest.fixture
def where(spark):
    return directory(
        spark,
        [(1, 10), (2, 10), (3, 30), (4, 40), (5, 50)],
        [
            (10, "Maine", "Portland"),
            (30, "Oregon", "Portland"),
            (40, "Ohio", "Dayton"),
            (50, "Utah", "Provo"),
        ],
    )


@pytest.fixture
def scope(spark, where):
    # Friday 5, Saturday 6, Sunday 7 January 2024; sensor 5 never has a value.
    data = [
        (1, at(5), 10.0, 1.0, 1.0),
        (1, at(6), 20.0, 1.0, 1.0),
        (2, at(5), 60.0, 1.5, 1.0),
        (3, at(5), 199.95, 3.0, 3.0),
        (3, at(7), 150.0, 3.0, 3.0),
        (4, at(5), None, None, 4.0),
        (4, at(5, hour=6), 14.0, None, 4.0),
        (5, at(5, month=2), None, 5.0, 5.0),
        (9, at(6, month=2, year=2023), 30.0, 9.0, 9.0),
    ]
    return Scope(spark.createDataFrame(data, SCHEMA), where)


def test_kpis(scope):
    found = reports.kpis(scope).first()
    assert tuple(found) == (5, pytest.approx(483.95 / 7), 199.95, 9)
    shown = reports.kpi_display(scope).first()
    assert tuple(shown) == ("5", "69.1", "199.9", "9")


def test_map_keeps_sites_apart_by_coordinates(scope):
    sites = reports.map_sites(scope).collect()
    assert [(r["location_id"], r["latitude"]) for r in sites] == [
        (30, 3.0), (10, 1.5), (9, 9.0), (10, 1.0), (50, 5.0)
    ]
    radius = {r["location_id"]: r["radius"] for r in sites}
    assert radius[9] == 60000.0 and radius[50] is None
    centre = reports.map_center(scope).first()
    assert tuple(centre) == (3.9, 3.8)
    assert tuple(reports.coord_coverage(scope).first()) == (9, 7, 6, 5)


def test_radius_has_a_floor(spark, where):
    df = spark.createDataFrame([(1, at(5), 2.0, 1.0, 1.0)], SCHEMA)
    assert reports.map_sites(Scope(df, where)).first()["radius"] == 10000.0


def test_ranking_drops_sites_without_coordinates(scope):
    top = reports.top_locations(scope, 3).collect()
    assert [(r["rank"], r["location_name"], r["measurements"]) for r in top] == [
        (1, "Portland, Oregon", 2), (2, "Portland, Maine", 1), (3, "Location 9", 1)
    ]
    assert top[0]["category"] == "🟣 Very Unhealthy" and top[0]["max_pm25"] == 200.0


def test_trend_by_bare_city_name(scope, rows):
    daily = reports.trend_daily(scope, ["Portland"])
    names = {r["location_name"] for r in daily.collect()}
    assert names == {"Portland, Maine", "Portland, Oregon"}
    many = ["a", "b", "c", "d", "e", "Portland"]
    assert reports.trend_daily(scope, many).count() == 0
    first = [r for r in daily.collect() if r["location_name"] == "Portland, Maine"]
    assert {r["date"].day: r["avg_pm25"] for r in first} == {5: 35.0, 6: 20.0}


def test_trend_defaults_to_top_cities(spark):
    sensors = [(i, i) for i in range(1, 8)]
    where = directory(spark, sensors, [(i, "S", f"C{i}") for i in range(1, 8)])
    df = spark.createDataFrame([(i, at(5), float(i), 0.0, 0.0) for i in range(1, 8)], SCHEMA)
    assert [r["city"] for r in reports.trend_cities(Scope(df, where)).collect()] == [
        "C7", "C6", "C5", "C4", "C3"
    ]
    assert reports.trend_daily(Scope(df, where)).count() == 5


def test_distribution_counts_missing_values(scope):
    table = {r["category"]: (r["n"], r["percentage"]) for r in
             reports.aqi_distribution(scope).collect()}
    assert sum(n for n, _ in table.values()) == 9
    assert table["Unknown"] == (2, 22.2) and table["Very Unhealthy (150+)"] == (2, 22.2)
    assert table["Moderate (12-35)"] == (3, 33.3)
    assert tuple(reports.aqi_rollup(scope).first()) == (11.1, 33.3, 33.3)


def test_extremes(scope):
    assert tuple(reports.extreme_summary(scope).first()) == (1, 2, 199.95)
    top = reports.extreme_top(scope).collect()
    # 199.95 shows as 200.0 and is judged as shown.
    assert [(r["severity"], r["value"], r["date"].day) for r in top] == [
        ("🔴 SEVERE", 200.0, 5), ("🟠 HIGH", 150.0, 7)
    ]


def test_extreme_ties_go_by_time(spark, where):
    df = spark.createDataFrame([(s, at(30 - s), 300.0, 0.0, 0.0) for s in range(1, 15)], SCHEMA)
    top = reports.extreme_top(Scope(df, where)).collect()
    assert [r["date"].day for r in top] == list(range(16, 26))


def test_weekdays(scope):
    table = {r["day_type"]: r for r in reports.weekday_weekend(scope).collect()}
    # 6 February 2023 was a Monday.
    weekday, weekend = table["Weekday"], table["Weekend"]
    assert (weekday["median"], weekday["max"], weekday["count"]) == (30.0, 199.95, 5)
    assert (weekend["mean"], weekend["median"], weekend["count"]) == (85.0, 85.0, 2)


def test_weekday_difference_bands(spark, where):
    def verdict(weekday, weekend):
        data = [(1, at(5), weekday, 0.0, 0.0), (1, at(6), weekend, 0.0, 0.0)]
        df = spark.createDataFrame(data, SCHEMA)
        found = reports.weekday_diff(Scope(df, where)).first()
        return found["diff_pct"], found["verdict"]

    assert verdict(105.0, 100.0) == (5.0, "similar")
    assert verdict(106.0, 100.0) == (6.0, "weekday higher")
    assert verdict(94.0, 100.0) == (-6.0, "weekend higher")
    assert verdict(94.0, 0.0) == (None, None)
    one = spark.createDataFrame([(1, at(5), 1.0, 0.0, 0.0)], SCHEMA)
    assert reports.weekday_diff(Scope(one, where)).count() == 0


def test_seasons_pool_years(scope):
    months = reports.seasonal(scope).collect()
    assert [(r["month"], r["month_name"], r["mean"]) for r in months] == [
        (1, "January", pytest.approx(453.95 / 6)), (2, "February", 30.0)
    ]
    assert tuple(reports.season_extremes(scope).first())[::2] == ("January", "February")


def test_season_ties_take_the_earlier_month(spark, where):
    data = [(1, at(5, month=m), 7.0, 0.0, 0.0) for m in (4, 2, 9)]
    found = reports.season_extremes(Scope(spark.createDataFrame(data, SCHEMA), where)).first()
    assert found["worst_month"] == found["best_month"] == "February"


def test_selection_applies_to_every_report(scope):
    chosen = Scope(scope.df, scope.where, Selection(states=["Oregon"], threshold=55))
    assert tuple(reports.kpis(chosen).first())[::3] == (1, 2)
    assert reports.aqi_distribution(chosen).collect()[0]["percentage"] == 100.0
    assert reports.extreme_top(chosen).count() == 2
    assert {r["day_type"]: r["count"] for r in reports.weekday_weekend(chosen).collect()} == {
        "Weekday": 1, "Weekend": 1
    }
    days = Scope(scope.df, scope.where, Selection(dt.date(2024, 1, 6), dt.date(2024, 1, 6)))
    assert reports.kpis(days).first()["rows"] == 1
    nothing = Scope(scope.df, scope.where, Selection(states=["Nowhere"]))
    assert tuple(reports.kpis(nothing).first()) == (0, None, None, 0)


def test_cube_gives_the_same_reports(spark, scope, folder, rows):
    for selection in (Selection(), Selection(cities=["Portland"], threshold=20)):
        plain = Scope(scope.df, scope.where, selection)
        cubed = with_cube(spark, plain, f"{folder}/cube")
        for name, report in REPORTS.items():
            assert rows(report(cubed)) == rows(report(plain)), name


def test_suite_writes_every_report(spark, scope, folder, rows):
    tables = run_suite(spark, scope, folder, selected_cities=["Dayton"])
    assert set(tables) == set(REPORTS)
    assert rows(tables["trend_daily"]) == rows(reports.trend_daily(scope, ["Dayton"]))


def test_order_of_rows_does_not_matter(scope, rows):
    mixed = Scope(scope.df.repartition(4).orderBy(F.rand(3)), scope.where)
    for name, report in REPORTS.items():
        assert rows(report(mixed)) == rows(report(scope)), name


def test_sensor_metadata(spark, scope):
    facts = scope.df.withColumn("parameter", F.lit("pm25"))
    found = {r["sensor_id"]: r for r in sensor_metadata(facts, scope.where).collect()}
    assert found[3]["last_seen"] == at(7) and found[3]["location_name"] == "Portland, Oregon"
    assert found[4]["latitude"] is None and found[9]["city"] == "Location 9"


value = st.one_of(st.none(), st.floats(-50, 2000), st.sampled_from([0.0, 1.0, 1.015625, 35.0]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), value), min_size=1, max_size=40))
def test_median_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, value double")
    found = {r["k"]: r["median"] for r in
             exact_median(df, ["k"]).collect()}
    want = {}
    for key in "ab":
        values = [v for k, v in data if k == key and v is not None]
        if values:
            want[key] = statistics.median(values)
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_median_of_many_values_in_a_narrow_range(spark, monkeypatch):
    """Two million distinct values within a thousandth; only the bracket is ranked."""
    monkeypatch.setattr(median, "ACCURACY", 1000)
    n = 2_000_000
    value = (F.col("id") * 7919 % n) * 1e-9 + 1
    df = spark.range(0, n, 1, 8).select(F.lit("a").alias("k"), value.alias("value"))
    df = df.unionByName(spark.createDataFrame([("b", 5.0), ("b", None), ("b", 7.0)], df.schema))
    frame = exact_median(df, ["k"])
    found = {r["k"]: r["median"] for r in frame.collect()}
    assert found == {"a": pytest.approx(1 + (n - 1) / 2 * 1e-9, abs=1e-12), "b": 6.0}
    plan = frame._jdf.queryExecution().executedPlan()
    ranked = int(re.search(r"hashpartitioning", plan.toString()) is not None)
    assert ranked and "percentile_approx" in plan.toString()


def test_daily_summary_against_brute_force(spark):
    data = [(i % 3, at(1 + i % 2, hour=i % 5), None if i % 7 == 0 else float(i * i % 23))
            for i in range(60)]
    df = spark.createDataFrame(data, "sensor_id long, datetime_utc timestamp_ntz, value double")
    found = daily.daily_summary(df.withColumn("parameter", F.lit("pm25"))).collect()
    assert len(found) == 6
    for r in found:
        group = [(t, v) for s, t, v in data if s == r["sensor_id"] and t.date() == r["date"]]
        values = [v for _, v in group if v is not None]
        assert r["median"] == statistics.median(values) and r["n"] == len(values)
        assert r["value"] == pytest.approx(sum(values) / len(values), rel=1e-12)
        hours = len({t.hour for t, _ in group})
        assert r["coverage_percent"] == round(hours * 100 / 24, 6)


def test_control_figures(spark):
    """Figures of the given sf0.01 tables that were found independently."""
    sf_dir = SMALL.replace("0.001", "0.01")
    everything = Scope(views.measurements(spark, sf_dir), views.places(spark, sf_dir))
    table = {r["category"]: (r["n"], r["percentage"]) for r in
             reports.aqi_distribution(everything).collect()}
    assert table == {
        "Good (0-12)": (2087, 20.9),
        "Moderate (12-35)": (2828, 28.3),
        "Unhealthy for Sensitive (35-55)": (1584, 15.8),
        "Unhealthy (55-150)": (2790, 27.9),
        "Very Unhealthy (150+)": (467, 4.7),
        "Unknown": (244, 2.4),
    }
    pm25 = Scope(views.pm25(spark, sf_dir), everything.where)
    best = reports.map_sites(pm25).first()
    ranked = reports.top_locations(pm25).first()
    assert ranked["rank"] == 1 and best["location_id"] == ranked["location_id"]
    sites = reports._sites(pm25).orderBy(F.desc("avg_pm25")).first()
    assert (sites["location_id"], round(sites["avg_pm25"], 6), sites["max_pm25"]) == (119, 65.195333, 238.01)


def parts_of(spark, folder, scope):
    from hazeline.plans.suite import with_parts

    return with_parts(spark, scope, f"{folder}/parts")


def near_values(spark, counts, seed=4):
    """Rows of weekdays and weekends whose values crowd in a few narrow ranges."""
    import random

    rng, data = random.Random(seed), []
    for day, n in counts.items():
        for i in range(n):
            value = rng.choice([None, 35.0, 35.0 + rng.random() * 1e-4, 36 + rng.random() * 1e-4, -2.5, 200.0])
            data.append((i % 7, dt.datetime(2024, 1, day, i % 24), value))
    return spark.createDataFrame(data, "sensor_id long, datetime_utc timestamp_ntz, value double")


@pytest.mark.parametrize("counts", [{3: 41, 6: 40}, {3: 1, 6: 2}, {4: 3}, {}], ids=str)
def test_median_from_counts_of_ranges(spark, folder, rows, counts):
    """Exact for odd and even counts, for middles in one range or two, and for equal values."""
    where = Directory(
        spark.createDataFrame([(1, 1)], "sensor_id long, location_id long"),
        spark.createDataFrame([(1, "A", "x")], "location_id long, state string, city string"),
    )
    for seed in (4, 5, 6):
        scope = reports.Scope(near_values(spark, counts, seed), where)
        columns = ("day_type", "median", "max", "count")
        got = rows(reports.weekday_weekend(parts_of(spark, f"{folder}/{seed}", scope)), *columns)
        assert got == rows(reports.weekday_weekend(scope), *columns)


def test_reports_from_parts_read_no_rows(spark, folder):
    from conftest import SMALL

    from hazeline.plans.suite import REPORTS
    from hazeline.queries import views

    scope = reports.Scope(views.pm25(spark, SMALL), views.places(spark, SMALL))
    scoped = parts_of(spark, folder, scope)
    for name, report in REPORTS.items():
        text = report(scoped)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in text, name


def test_equal_extreme_rows_are_all_shown(spark, folder, rows):
    where = Directory(
        spark.createDataFrame([], "sensor_id long, location_id long"),
        spark.createDataFrame([], "location_id long, state string, city string"),
    )
    stamp = dt.datetime(2024, 1, 3, 4)
    data = [(1, stamp, 300.0)] * 3 + [(2, stamp, 160.0)] * 2 + [(3, stamp, 149.9), (4, stamp, None)]
    frame = spark.createDataFrame(data, "sensor_id long, datetime_utc timestamp_ntz, value double")
    frame = frame.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0)})
    scope = reports.Scope(frame, where)
    scoped = parts_of(spark, folder, scope)
    for top_n in (2, 4, 10):
        assert rows(reports.extreme_top(scoped, top_n=top_n)) == rows(reports.extreme_top(scope, top_n=top_n))
    assert rows(reports.extreme_summary(scoped)) == rows(reports.extreme_summary(scope)) == [(2, 1, 300.0)]
