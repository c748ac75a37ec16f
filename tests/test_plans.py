"""What the plans must and must not contain."""

import datetime as dt
import re

import pytest
from conftest import SMALL
from pyspark.sql import types as T

from hazeline.operators import filters, merge, places, prefilter, sizing
from hazeline.plans import reports
from hazeline.plans.loading import Selection, filter_all, select_rows
from hazeline.plans.reports import Scope
from hazeline.queries import views
from hazeline.queries.catalog import REGISTRY
from hazeline.schemas import FACT
from hazeline.sources.landing import ARRIVAL
from hazeline.sources.tables import FactTable

LANDING = {
    "ingest_flatten", "ingest_batch", "ingest_backfill", "backfill_facts", "stream_ingest",
    "export_counts", "report_suite",
}


STAGED_ROWS = T.StructType(
    [
        *FACT.fields,
        T.StructField("arrival_file", T.StringType()),
        T.StructField("arrival_block", T.LongType()),
        T.StructField("arrival_line", T.LongType()),
        T.StructField("arrival_pos", T.IntegerType()),
    ]
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - LANDING))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(REGISTRY[name](spark, SMALL))
    for banned in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text


def test_filters_reach_the_scan(spark):
    facts = views.table(spark, SMALL, "events").selectExpr(
        "user_id AS sensor_id", "ts AS datetime_utc", "value", "event_type AS parameter"
    )
    selection = Selection(dt.date(2024, 1, 5), dt.date(2024, 1, 9), threshold=35)
    rows = select_rows(facts.where("parameter = 'click'"), selection)
    text = plan(rows.select("sensor_id", "value"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(event_type,click)", "GreaterThanOrEqual(value,35.0)", "ts,2024-01-0"):
        assert part in pushed
    assert "props" not in text


def test_rows_shrink_before_they_move(spark):
    """Facts are aggregated by sensor below the first exchange and every join."""
    scope = Scope(views.pm25(spark, SMALL), views.places(spark, SMALL))
    for report in (reports.kpis, reports.map_sites, reports.top_locations):
        text = plan(report(scope))
        scan = text.index("events.parquet")
        below = text[:scan]
        last_join = max(below.rfind("Join ["), below.rfind("Join("))
        assert "partial_sum" in below[max(below.rfind("Exchange hashpartitioning"), last_join) :]


def test_top_reports_do_not_sort_everything(spark):
    scope = Scope(views.pm25(spark, SMALL), views.places(spark, SMALL))
    for report in (reports.top_locations, reports.extreme_top, reports.trend_cities):
        text = plan(report(scope))
        # What is sorted as a whole is what the limit has left.
        assert text.rfind("rangepartitioning") < text.index("TakeOrderedAndProject")


def test_dedup_cuts_rows_before_the_shuffle(spark):
    rows = views.with_date(views.measurements(spark, SMALL))
    text = plan(merge.accepted_rows(rows.where("value > 5"), rows, ["arrival"], views.DAILY_KEY))
    assert re.search(r"WindowGroupLimit[^\n]*Partial", text)
    # The batch is shuffled once, for dedup and anti join together.
    batch_side = text[: text.rindex("Exchange hashpartitioning")]
    assert batch_side.count("Exchange hashpartitioning(sensor_id") <= 1


def test_trend_reads_rows_once(spark):
    frame = REGISTRY["trend_daily"](spark, SMALL)
    frame.collect()
    text = plan(frame).split("Initial Plan")[0]
    assert text.count("events.parquet") == 1 and "ReusedExchange" in text


def test_median_shuffles_no_rows(spark):
    """Rows are summed, sketched, or cut to the bracket before any exchange."""
    text = plan(REGISTRY["weekday_weekend"](spark, SMALL))
    assert text.count("events.parquet") == 3
    for below in text.split("Exchange hashpartitioning")[1:]:
        assert "Aggregate(" in below.split("\n")[1]


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
def test_rows_meet_one_table_of_places(spark, monkeypatch, limit):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    facts = views.pm25(spark, SMALL)
    text = plan(places.enrich(facts, views.places(spark, SMALL)))
    # Joins above the facts: one, and one more that marks hot keys in the shuffled way.
    above = text[: text.index("events.parquet")]
    assert above.count("LeftOuter") <= (1 if limit > 0 else 5)
    assert (text.count("events.parquet") == 1) == (limit > 0)


def test_merge_reads_only_the_times_of_the_batch(spark, tmp_path):
    table = FactTable(spark, str(tmp_path / "facts"))
    day = dt.datetime(2024, 1, 5)
    row = (1, "pm25", day, day, 1.0, "x", None, None, None, None, None, None)
    table.append(spark.createDataFrame([row], FACT), "a")
    batch = spark.createDataFrame([(*row, "f", 0, 0, 0)], STAGED_ROWS)
    stored = table.read({"2024-01": (day, day)}, skip_batch="b")
    text = plan(merge.marked_rows(stored, batch, ARRIVAL))
    assert "GreaterThanOrEqual(datetime_utc" in text and "LessThanOrEqual(datetime_utc" in text
    batch_side = text[: text.index("Scan parquet")]
    assert batch_side.count("Exchange hashpartitioning(sensor_id") <= 2


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
def test_other_sensors_are_cut_at_the_scan(spark, monkeypatch, limit):
    """Whether places are broadcast or shuffled, the scan itself knows the chosen sensors."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    rows = filter_all(views.pm25(spark, SMALL), views.places(spark, SMALL), Selection(states=["ASIA"]))
    text = plan(rows)
    scans = re.findall(r"events.parquet.*?PushedFilters: \[(.*?)\], ReadSchema", text)
    assert scans and all("In(user_id" in pushed or "user_id >=" in pushed for pushed in scans)


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, -1])
def test_many_chosen_sensors_are_a_bit_map_above_the_scan(spark, monkeypatch, limit):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(prefilter, "LISTED", 0)
    rows = filter_all(views.pm25(spark, SMALL), views.places(spark, SMALL), Selection(states=["ASIA"]))
    text = plan(rows)
    for below in text.split("events.parquet")[:-1]:
        path = below.split("\n")
        above = [line for line in path if "getbit" in line or "Exchange hashpartitioning" in line]
        assert "getbit" in above[-1]  # no exchange of rows between the scan and the bit map


def test_reports_of_places_cut_rows_at_the_scan(spark):
    scope = Scope(views.pm25(spark, SMALL), views.places(spark, SMALL), Selection(cities=["NATION_7"]))
    for report in (reports.kpis, reports.trend_daily, reports.extreme_summary, reports.weekday_weekend):
        pushed = re.findall(r"events.parquet.*?PushedFilters: \[(.*?)\], ReadSchema", plan(report(scope)))
        assert pushed and all("user_id" in p.replace("IsNotNull(user_id)", "") for p in pushed)


def test_month_filter_follows_the_dates(spark):
    df = spark.createDataFrame([], "datetime_utc timestamp_ntz, month string, value double")
    text = filters.filter_date(df, dt.date(2024, 1, 5), dt.date(2024, 3, 1))
    text = text._jdf.queryExecution().analyzed().toString()
    assert ">= 2024-01)" in text and "<= 2024-03)" in text
