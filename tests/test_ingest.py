"""Batch and streaming ingest over small landings."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from hazeline.operators.cleaning import dedup_first
from hazeline.plans import ingest
from hazeline.plans.daily import daily_summary
from hazeline.schemas import SIGNAL
from hazeline.sources.dimensions import read_sensor_map
from hazeline.sources.landing import read_location_pages, read_page_stream, read_pages
from hazeline.sources.tables import FactTable, SnapshotTable
from hazeline.streaming import jobs
from hazeline.streaming.daily import DailySink


def result(day, value, name="pm25", month=1, **more):
    utc = f"2024-{month:02d}-{day:02d}T05:00:00Z"
    local = f"2024-{month:02d}-{day:02d}T00:00:00-05:00"
    return {
        "value": value,
        "parameter": {"name": name, "units": "µg/m³"},
        "period": {"datetime_from": {"utc": utc, "local": local}},
        **more,
    }


def land(path, pages, name="a.json"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as out:
        for page in pages:
            out.write((page if isinstance(page, str) else json.dumps(page)) + "\n")
    return path


LOCATIONS = [
    {
        "id": 100,
        "sensors": [
            {"id": 1, "name": "a", "parameter": {"name": "PM25"},
             "coordinates": {"latitude": 1.0, "longitude": 2.0}},
            {"id": 2, "name": "b", "parameter": {"name": "o3"}},
        ],
    },
    {"id": 200, "sensors": [{"id": 3, "name": "c", "parameter": {"name": "pm25"}}]},
    {"id": 300, "sensors": []},
]
FIRST = [
    {"sensor_id": 1, "results": [result(1, 10.0), result(2, 11.0), result(2, 99.0)]},
    {"sensor_id": 2, "results": [result(1, 50.0)]},
    '{"sensor_id": 1, "results": [{"val',
    {"sensor_id": None, "results": [result(9, 1.0)]},
]
SECOND = [
    {"sensor_id": 1, "results": [result(2, 12.0), result(3, 13.0, month=2), result(30, 5.0)]}
]


@pytest.fixture
def landed(spark, folder):
    land(f"{folder}/first", FIRST)
    land(f"{folder}/second", SECOND)
    land(f"{folder}/locations", LOCATIONS)
    return folder


@pytest.fixture
def asked(spark):
    return spark.createDataFrame([(100,), (200,), (300,), (400,)], "location_id long")


def stored(facts):
    found = facts.read().orderBy("sensor_id", "datetime_utc").collect()
    return [(r["sensor_id"], r["datetime_utc"].month, r["datetime_utc"].day, r["value"])
            for r in found]


def run_scheduled(spark, landed, asked, facts, batch, **more):
    return ingest.scheduled_run(
        spark,
        f"{landed}/{batch}",
        read_location_pages(spark, f"{landed}/locations"),
        asked,
        None,
        facts,
        batch,
        f"{landed}/stage",
        **more,
    )


def test_scheduled_runs(spark, landed, asked):
    facts = FactTable(spark, f"{landed}/facts")
    more = {"map_path": f"{landed}/map"}
    first = run_scheduled(spark, landed, asked, facts, "first", **more)
    assert first == ingest.IngestStats(2, 2, 0, 2)
    assert stored(facts) == [(1, 1, 1, 10.0), (1, 1, 2, 11.0)]
    second = run_scheduled(spark, landed, asked, facts, "second", end="2024-02-28")
    # 2 January is stored already; its correction is not applied.
    assert second == ingest.IngestStats(3, 2, 1, 0)
    want = [(1, 1, 1, 10.0), (1, 1, 2, 11.0), (1, 1, 30, 5.0), (1, 2, 3, 13.0)]
    assert stored(facts) == want
    # Any run again, in any order, changes nothing.
    assert run_scheduled(spark, landed, asked, facts, "first", **more) == first
    assert run_scheduled(spark, landed, asked, facts, "second", end="2024-02-28") == second
    assert stored(facts) == want
    row = facts.read().first()
    assert row["parameter"] == "pm25" and (row["latitude"], row["longitude"]) == (1.0, 2.0)
    assert row["datetime_local"].hour == 0
    found = {tuple(r) for r in read_sensor_map(spark, f"{landed}/map").collect()}
    assert found == {(1, 100), (3, 200)}
    bad = ingest.staged_rows(spark, f"{landed}/stage", "first", ingest.BAD).collect()
    assert sorted(r["corrupt_line"] is None for r in bad) == [False, True]


def test_backfill_summary(spark, landed, asked):
    facts = FactTable(spark, f"{landed}/facts")
    summary = ingest.backfill_run(
        spark,
        f"{landed}/first",
        read_location_pages(spark, f"{landed}/locations"),
        asked,
        spark.createDataFrame([(100, 7.0, 8.0)], "location_id long, latitude double, longitude double"),
        facts,
        "one",
        f"{landed}/stage",
        "1/2/2024",
        "January 31, 2024",
    )
    assert summary.first().asDict() == {
        "successful_sensors": 1,
        "failed_sensors": 1,
        "skipped_locations": 2,
        "total_locations": 4,
        "sensor_mappings": 2,
        "total_rows_attempted": 1,
        "total_rows_inserted": 1,
        "total_duplicates": 0,
    }
    assert facts.read().first()["latitude"] == 7.0


def test_both_ends_of_the_range_count(spark, folder):
    land(f"{folder}/p", [{"sensor_id": 1, "results": [result(d, float(d)) for d in range(1, 6)]}])
    rows = ingest.clean_pages(
        read_pages(spark, f"{folder}/p"), start="2024-01-02T05:00:00Z", end="2024-01-04T05:00:00Z"
    )
    assert sorted(r["value"] for r in rows.collect()) == [2.0, 3.0, 4.0]
    with pytest.raises(Exception, match="not a date"):
        ingest.clean_pages(read_pages(spark, f"{folder}/p"), start="soon").collect()


def test_nothing_landed(spark, folder):
    land(f"{folder}/p", [{"sensor_id": 1, "results": []}])
    facts = FactTable(spark, f"{folder}/facts")
    stats = ingest.ingest_batch(
        spark, read_pages(spark, f"{folder}/p"), facts, "x", f"{folder}/stage"
    )
    assert stats == ingest.IngestStats(0, 0, 0, 0)


def test_stream_equals_batch(spark, landed):
    """Three runs of the stream, the last without new files, against two batches."""
    batch = FactTable(spark, f"{landed}/batch")
    for name in ("first", "second"):
        ingest.ingest_batch(
            spark, read_pages(spark, f"{landed}/{name}"), batch, name, f"{landed}/stage"
        )
    facts = FactTable(spark, f"{landed}/streamed")
    for pages in (FIRST, SECOND, None):
        if pages:
            land(f"{landed}/landing", pages, f"{len(pages)}.json")
        jobs.start_ingest(
            spark,
            read_page_stream(spark, f"{landed}/landing"),
            facts,
            f"{landed}/stage-stream",
            f"{landed}/checkpoint",
            "stream",
        ).awaitTermination()
    assert stored(facts) == stored(batch) and len(stored(facts)) == 5


def test_two_streams_feed_one_table(spark, landed):
    facts = FactTable(spark, f"{landed}/facts")

    def run(source, name):
        jobs.start_ingest(
            spark,
            read_page_stream(spark, f"{landed}/{name}"),
            facts,
            f"{landed}/stage",
            f"{landed}/checkpoint-{source}-{name}",
            source,
        ).awaitTermination()

    run("north", "first")
    run("south", "second")
    both = stored(facts)
    assert len(both) == 5
    # A new checkpoint under a used name would start again at batch 0.
    with pytest.raises(Exception, match="holds other input"):
        run("north", "second")
    assert stored(facts) == both


def test_a_used_batch_name_with_other_files_is_refused(spark, landed, asked):
    facts = FactTable(spark, f"{landed}/facts")
    run_scheduled(spark, landed, asked, facts, "first")
    before = stored(facts)
    with pytest.raises(ValueError, match="holds other input"):
        ingest.ingest_batch(
            spark, read_pages(spark, f"{landed}/second"), facts, "first", f"{landed}/stage"
        )
    assert stored(facts) == before


def test_a_shorter_rerun_leaves_no_month(spark, landed):
    facts = FactTable(spark, f"{landed}/facts")

    def run(end):
        pages = read_pages(spark, f"{landed}/second")
        return ingest.ingest_batch(spark, pages, facts, "x", f"{landed}/stage", end=end)

    assert run(None).inserted == 3 and len(stored(facts)) == 3
    stats = run("2024-01-20")
    assert stats == ingest.IngestStats(1, 1, 0, 0) and stored(facts) == [(1, 1, 2, 12.0)]


def event_files(spark, folder, days):
    """One file per call, as a stream source would see them arrive."""
    rows = [
        (d % 2, "pm25", dt.datetime(2024, 1, d, h), float(d * 10 + h)) for d in days for h in (1, 2)
    ]
    made = spark.createDataFrame(
        rows, "sensor_id long, parameter string, datetime_utc timestamp_ntz, value double"
    )
    made.coalesce(1).write.mode("append").parquet(f"{folder}/events")
    return spark.readStream.schema(made.schema).parquet(f"{folder}/events")


def drain(spark, rows, folder):
    jobs.start_to_parquet(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def test_daily_stream_drops_late_rows(spark, folder):
    stream = event_files(spark, folder, [1, 2, 3])
    drain(spark, jobs.daily_stream(stream, "1 day"), folder)
    event_files(spark, folder, [7, 8])
    drain(spark, jobs.daily_stream(stream, "1 day"), folder)
    event_files(spark, folder, [1, 9])
    got = drain(spark, jobs.daily_stream(stream, "1 day"), folder)
    days = {r["date"].day: r["n"] for r in got.collect()}
    # Day 1 arrived again after the watermark had passed it.
    assert days[1] == 2 and set(days) == {1, 2, 3, 7} and all(n == 2 for n in days.values())


def test_daily_stream_has_open_days_and_counts_late_rows(spark, folder):
    stream, late = event_files(spark, folder, [1, 2, 3]), 0
    for days in (None, [7, 8], [1, 9]):
        if days:
            event_files(spark, folder, days)
        query = jobs.start_daily(stream, f"{folder}/days", f"{folder}/checkpoint", "1 day")
        query.awaitTermination()
        late += jobs.late_rows(query)
    found = {r["date"].day: r["n"] for r in jobs.read_daily(spark, f"{folder}/days").collect()}
    assert found == {1: 2, 2: 2, 3: 2, 7: 2, 8: 2, 9: 2} and late >= 1


def readings(spark, data):
    made = [(s, "pm25", dt.datetime(2024, 1, d, h), v) for s, d, h, v in data]
    return spark.createDataFrame(made, "sensor_id long, parameter string, datetime_utc timestamp_ntz, value double")


def test_daily_sink_equals_the_batch_job(spark, folder, rows):
    """Whatever the micro-batches, ties, missing values and keys: the same figures, and no folder for each."""
    rng = random.Random(2)
    data = [
        (rng.choice([1, 2, None]), rng.randrange(1, 6), rng.randrange(24), rng.choice([None, 1.5, rng.random(), 7.0]))
        for _ in range(300)
    ]
    sink = DailySink(spark, folder, jobs.DAILY_KEYS, "30 days")
    for number in range(10):
        sink.update(readings(spark, data[number::10]), number)
    got, want = jobs.read_daily(spark, folder), daily_summary(readings(spark, data))
    figures = lambda df: [
        tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        for r in rows(df, "date", "sensor_id", "parameter", "value", "min", "max", "coverage_percent", "n", "median")
    ]
    assert figures(got) == figures(want)
    assert len([d for d in os.listdir(f"{folder}/days") if "=" in d]) == 5
    assert sink.progress().number == 9 and sink.progress().late == 0
    assert {d for d in os.listdir(folder)} == {"days", "merged", "progress"}


def test_daily_sink_counts_every_late_row(spark, folder):
    sink = DailySink(spark, folder, jobs.DAILY_KEYS, "1 day")
    for number, day in enumerate([5, 6, 20, 4, 19, 3]):
        sink.update(readings(spark, [(s, day, 1, 1.0) for s in range(10)] * 2), number)
    found = {r["date"].day: r["n"] for r in jobs.read_daily(spark, folder).collect()}
    # Days 4 and 3 came after day 20; day 19 had not been closed for a whole day.
    assert found == {5: 2, 6: 2, 19: 2, 20: 2}
    assert sink.progress().late == 40


@pytest.mark.parametrize("died", ["merged", "days"])
def test_daily_sink_survives_a_death_between_its_writes(spark, folder, died, monkeypatch):
    """The micro-batch runs again after its merged days, or its days too, were written."""
    sink, first, second = DailySink(spark, folder, jobs.DAILY_KEYS), [(1, 2, 3, 4.0)], [(1, 2, 5, 6.0), (1, 3, 5, 6.0)]
    sink.update(readings(spark, first), 0)

    class Died(Exception):
        pass

    def die(*args, **kwargs):
        raise Died

    batch = readings(spark, second)
    if died == "merged":
        monkeypatch.setattr(type(batch), "hint", die)
    else:
        monkeypatch.setattr(type(spark), "createDataFrame", die)
    with pytest.raises(Died):
        sink.update(batch, 1)
    monkeypatch.undo()
    sink.update(readings(spark, second), 1)
    sink.update(readings(spark, second), 1)  # done already
    found = {r["date"].day: (r["n"], r["median"]) for r in jobs.read_daily(spark, folder).collect()}
    assert found == {2: (2, 5.0), 3: (1, 6.0)}


def test_first_stream_equals_the_batch_dedup(spark, folder, rows):
    """Whatever micro-batches they come in, the first to have arrived of each key, and each key once."""
    rng = random.Random(4)
    schema = "arrival long, sensor_id long, parameter string, datetime_utc timestamp_ntz, value double"
    data = [
        (i, rng.randrange(3), rng.choice(["pm25", None]), dt.datetime(2024, 1, 1 + i // 40, rng.randrange(24)), rng.choice([None, rng.random()]))
        for i in rng.sample(range(200), 200)
    ]
    made = spark.createDataFrame(data, schema)
    os.makedirs(f"{folder}/in")
    stream = spark.readStream.schema(made.schema).parquet(f"{folder}/in")
    for part in (data[:80], data[80:150], data[150:], None):
        sent = jobs.heartbeat(spark, dt.datetime(2030, 1, 1), made.schema) if part is None else spark.createDataFrame(part, schema)
        sent.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        got = drain(spark, jobs.first_stream(stream, ["arrival"], "20 days"), folder)
    assert rows(got) == rows(dedup_first(made, ["arrival"]).select(*made.columns))


def test_dedup_stream_keeps_real_rows(spark, folder):
    stream = event_files(spark, folder, [1, 2])
    event_files(spark, folder, [2, 3])
    got = drain(spark, jobs.dedup_stream(stream), folder)
    assert got.count() == 6 and got.select("datetime_utc").distinct().count() == 6


def test_alerts(spark, folder):
    stream = event_files(spark, folder, [1, 15, 16])
    assert drain(spark, jobs.alerts(stream, 152.0), folder).count() == 3


def test_marks_never_move_back(spark, folder):
    signal = SnapshotTable(spark, f"{folder}/signal", SIGNAL)
    for days in ([5, 6], [1, 2], [8]):
        stream = event_files(spark, folder, days)
        now = dt.datetime(2024, 2, 1)
        jobs.start_signal(stream, signal, f"{folder}/checkpoint", now).awaitTermination()
    got = {r["sensor_id"]: r["last_data_datetime_utc"].day for r in signal.read().collect()}
    assert got == {1: 5, 0: 8}


def test_hot_sensor_ingest(spark, folder):
    """A third of all rows on one key, far more duplicates than days."""
    pages = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("string").alias("sensor_id"),
        F.array(
            F.struct(
                F.col("id").cast("string").alias("value"),
                F.struct(
                    F.struct(
                        F.lit("2024-01-01T05:00:00Z").alias("utc"),
                        F.lit("2024-01-01T00:00:00-05:00").alias("local"),
                    ).alias("datetime_from")
                ).alias("period"),
            )
        ).alias("results"),
    )
    pages.write.json(f"{folder}/p")
    facts = FactTable(spark, f"{folder}/facts")
    read = read_pages(spark, f"{folder}/p")
    stats = ingest.ingest_batch(spark, read, facts, "x", f"{folder}/stage")
    assert (stats.attempted, stats.inserted) == (400, 400)
