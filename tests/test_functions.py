"""Column functions against hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.functions import categories, numbers
from hazeline.functions.dates import day_type, local_clock, month_name, to_iso_text, utc_clock
from hazeline.functions.text import (
    is_pm25,
    location_list,
    looks_like_pm25,
    region_overrides,
)


def column(spark, values, kind, use):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    found = df.select("i", use(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in found]


@pytest.mark.parametrize(
    "text, iso",
    [
        ("1/1/2020", "2020-01-01T00:00:00Z"),
        ("01/01/2020", "2020-01-01T00:00:00Z"),
        ("2020-1-1", "2020-01-01T00:00:00Z"),
        ("January 15, 2023", "2023-01-15T00:00:00Z"),
        ("Jan 1 2020", "2020-01-01T00:00:00Z"),
        ("2024-12-31", "2024-12-31T00:00:00Z"),
        ("2020/01/01", "2020-01-01T00:00:00Z"),
        ("13/1/2020", "2020-01-13T00:00:00Z"),
        ("15 Sept 2021", "2021-09-15T00:00:00Z"),
        ("2024-05-06T07:08:09.123-05:00", "2024-05-06T07:08:09Z"),
        ("8/9/2024 1:02:03", "2024-08-09T01:02:03Z"),
        ("anything goes Z", "anything goes Z"),
        ("2024-13-45", None),
        ("soon", None),
        (None, None),
    ],
)
def test_date_text(spark, text, iso):
    assert column(spark, [text], "string", to_iso_text) == [iso]


@pytest.mark.parametrize(
    "text, iso",
    [
        ("20240115", "2024-01-15T00:00:00Z"),
        ("20240115 06:30", "2024-01-15T06:30:00Z"),
        ("1/5/2024 3:00 PM", "2024-01-05T15:00:00Z"),
        ("1/5/2024 12:05 am", "2024-01-05T00:05:00Z"),
        ("1/5/2024 12:05:30 pm", "2024-01-05T12:05:30Z"),
        ("1/5/24", "2024-01-05T00:00:00Z"),
        ("13/1/99", "1999-01-13T00:00:00Z"),
        ("20241315", None),
        ("1/5/2024 13:00 PM", None),
        ("123456789", None),
    ],
)
def test_short_date_text(spark, text, iso):
    assert column(spark, [text], "string", to_iso_text) == [iso]


def test_clocks(spark):
    utc = column(
        spark,
        ["2024-01-01T05:00:00Z", "2024-01-01T00:00:00-05:00", "2024-01-01 05:00:00", "x", None],
        "string",
        utc_clock,
    )
    assert utc == [dt.datetime(2024, 1, 1, 5)] * 3 + [None, None]
    local = column(spark, ["2024-07-01T01:00:00-04:00", "?", None], "string", local_clock)
    assert local == [dt.datetime(2024, 7, 1, 1), None, None]


def test_day_type_and_month_name(spark):
    days = [dt.date(2024, 1, d) for d in (5, 6, 7, 8)]
    assert column(spark, days, "date", day_type) == ["Weekday", "Weekend", "Weekend", "Weekday"]
    assert column(spark, [dt.date(2024, 2, 3)], "date", month_name) == ["February"]


def test_numbers_from_text(spark):
    texts = ["12.5", " 7 ", "1e2", "n/a", "", "nan", "1.0d", "2f", "0x1p3", None, "-3"]
    want = [12.5, 7.0, 100.0, None, None, None, None, None, None, None, -3.0]
    assert column(spark, texts, "string", numbers.to_number) == want


def test_ids_from_text(spark):
    texts = ["12", "12.0", "12.5", "abc", None, "9007199254740993"]
    assert column(spark, texts, "string", numbers.to_id) == [
        12, 12, None, None, None, 9007199254740993
    ]


def test_nan_is_missing(spark):
    assert column(spark, [float("nan"), 1.0, None], "double", numbers.no_nan) == [None, 1.0, None]


def test_rounding_is_half_even(spark):
    assert column(spark, [0.25, 0.35, 199.95, 2.5], "double", numbers.half_even) == [
        0.2, 0.4, 200.0, 2.5
    ]


def test_display_text(spark):
    values = [1234.56, 0.0, None]
    assert column(spark, values, "double", numbers.display) == ["1,234.6", "0.0", "—"]
    assert column(spark, values, "double", numbers.display_int) == ["1,234", "0", "—"]
    assert column(spark, values, "double", numbers.tooltip) == ["1234.6", "0.0", "N/A"]


def test_band_limits(spark):
    values = [11.99, 12.0, 34.99, 35.0, 54.99, 55.0, 149.99, 150.0, None]
    assert column(spark, values, "double", categories.band) == [0, 1, 1, 2, 2, 3, 3, 4, -1]
    longs = column(spark, [0.0, 150.0, None], "double", categories.long_label)
    assert longs == ["Good (0-12)", "Very Unhealthy (150+)", "Unknown"]
    shorts = column(spark, [40.0, None], "double", categories.short_label)
    assert shorts == ["🟠 Unhealthy (Sensitive)", "Unknown"]
    colours = column(spark, [60.0, None], "double", categories.colour)
    assert [list(c) for c in colours] == [[255, 0, 0], [128, 128, 128]]


def test_parameter_names(spark):
    names = ["pm25", "PM25", "PM2.5", "pm_25", "pm10", "o3", None]
    assert column(spark, names, "string", is_pm25) == [
        True, True, False, False, False, False, False
    ]
    assert column(spark, names, "string", looks_like_pm25) == [
        True, True, True, True, False, False, False
    ]


def test_location_list(spark):
    found = {r[0] for r in location_list(spark, "1671, 564,,564 ").collect()}
    assert found == {1671, 564}
    with pytest.raises(Exception, match="not a location id: abc"):
        location_list(spark, "1671,abc").collect()


def test_region_overrides(spark):
    text = "3:North, 8: South ,bad,x:y,12:,3:Coast,5:a:b"
    found = {tuple(r) for r in region_overrides(spark, text).collect()}
    assert found == {(3, "Coast"), (8, "South"), (12, ""), (5, "a:b")}
