"""Means keep all digits and take any number that can be stored."""

import datetime as dt

import pytest

from hazeline.functions.numbers import to_number
from hazeline.operators.places import Directory
from hazeline.plans import reports
from hazeline.plans.daily import daily_summary
from hazeline.plans.reports import Scope

WHEN = dt.datetime(2024, 1, 3)


@pytest.fixture
def where(spark):
    return Directory(
        spark.createDataFrame([(1, 100)], "sensor_id long, location_id long"),
        spark.createDataFrame([(100, "Ohio", "Dayton")], "location_id long, state string, city string"),
        spark.createDataFrame([(100, 1.0, 2.0)], "location_id long, latitude double, longitude double"),
    )


def scope(spark, where, *values):
    rows = [(1, WHEN + dt.timedelta(minutes=i), v) for i, v in enumerate(values)]
    return Scope(
        spark.createDataFrame(rows, "sensor_id long, datetime_utc timestamp_ntz, value double"), where
    )


@pytest.mark.parametrize("values, mean", [([1e300, 12.5], 5e299), ([4e-7, 4e-7], 4e-7), ([], None)])
def test_odd_values(spark, where, values, mean):
    some = scope(spark, where, *values)
    assert reports.kpis(some).first()["avg_pm25"] == mean
    assert reports.weekday_weekend(some).collect() == [] or (
        reports.weekday_weekend(some).first()["mean"] == mean
    )
    reports.map_display(some).collect()
    reports.seasonal(some).collect()
    if values:
        daily = daily_summary(some.df.selectExpr("*", "'pm25' AS parameter")).first()
        assert daily["value"] == mean


def test_stored_extremes_can_be_read(spark):
    text = spark.createDataFrame([("1e300",), ("12.5",)], "t string")
    assert text.select(to_number(text.t).alias("v")).agg({"v": "avg"}).first()[0] == 5e299


def test_category_follows_the_unrounded_mean(spark, where):
    row = reports.top_locations(scope(spark, where, 34.9999998)).first()
    assert (row["avg_pm25"], row["category"]) == (35.0, "🟡 Moderate")
    row = reports.top_locations(scope(spark, where, 12.2500003)).first()
    assert row["avg_pm25"] == row["max_pm25"] == 12.3
    dot = reports.map_display(scope(spark, where, 34.9999998)).first()
    assert list(dot["colour"]) == [255, 255, 0]


def test_band_follows_the_unrounded_difference(spark, where):
    saturday = dt.datetime(2024, 1, 6)
    rows = [(1, WHEN, 105.00000004), (1, saturday, 100.0)]
    df = spark.createDataFrame(rows, "sensor_id long, datetime_utc timestamp_ntz, value double")
    assert reports.weekday_diff(Scope(df, where)).first()["verdict"] == "weekday higher"
