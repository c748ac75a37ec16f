"""Dedup, insert-ignore and upserts."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hazeline.operators import merge
from hazeline.operators.cleaning import dedup_first

KEYS = ["sensor_id", "parameter", "datetime_utc"]
SCHEMA = "sensor_id long, parameter string, datetime_utc timestamp_ntz, value double, n long"
AS_OF = dt.datetime(2024, 6, 1)


def frame(spark, data):
    made = [(s, "pm25", dt.datetime(2024, 1, 1 + d), v, n) for s, d, v, n in data]
    return spark.createDataFrame(made, SCHEMA)


def test_first_arrival_stays(spark, rows):
    batch = frame(spark, [(1, 0, 5.0, 2), (1, 0, 4.0, 1), (1, 1, 9.0, 3), (2, 0, 7.0, 4)])
    assert rows(dedup_first(batch, ["n"]), "n") == [(1,), (3,), (4,)]


def test_stored_row_wins(spark, rows):
    stored = frame(spark, [(1, 0, 1.0, 0)])
    batch = frame(spark, [(1, 0, 99.0, 1), (1, 1, 2.0, 3), (1, 1, 3.0, 2)])
    merged = merge.insert_ignore(stored, batch, ["n"])
    assert rows(merged, "value", "n") == [(1.0, 0), (3.0, 2)]
    stats = merge.ingest_stats(stored, batch).first()
    assert tuple(stats) == (2, 1, 1)


row = st.tuples(st.integers(0, 3), st.integers(0, 3), st.floats(0, 500))
batches = st.lists(st.lists(row, max_size=8), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches)
def test_any_batches_keep_keys_unique(spark, made):
    """Against a plain dict that ignores known keys; each batch is sent twice."""
    stored, expected, number = frame(spark, []), {}, 0
    for batch in made:
        numbered = []
        for s, d, v in batch:
            numbered.append((s, d, v, number))
            expected.setdefault((s, d), number)
            number += 1
        for _ in range(2):
            random.shuffle(numbered)
            stored = merge.insert_ignore(stored, frame(spark, numbered), ["n"])
    found = [((r["sensor_id"], r["datetime_utc"].day - 1), r["n"]) for r in stored.collect()]
    assert len(found) == len(expected) and dict(found) == expected


META = (
    "sensor_id long, sensor_name string, parameter string, latitude double, longitude double,"
    " region string, last_seen timestamp_ntz"
)


def test_metadata_upsert(spark):
    old, seen = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 2)
    stored = spark.createDataFrame(
        [(1, "a", "pm25", 1.0, 2.0, "West", old, old), (2, "b", "pm25", 3.0, 4.0, "East", old, old)],
        META + ", updated_at timestamp",
    )
    batch = spark.createDataFrame(
        [(1, None, "pm25", None, 9.0, "Unknown", None), (3, "c", "pm25", None, None, "East", seen)],
        META,
    )
    found = {r["sensor_id"]: r for r in merge.upsert_metadata(stored, batch, AS_OF).collect()}
    assert tuple(found[1])[1:7] == (None, "pm25", 1.0, 9.0, "Unknown", old)
    assert found[1]["updated_at"] == AS_OF and found[2]["updated_at"] == old
    assert found[2]["sensor_name"] == "b" and found[3]["last_seen"] == seen


def test_metadata_batch_applies_in_order(spark):
    stored = spark.createDataFrame([], META + ", updated_at timestamp")
    batch = spark.createDataFrame(
        [(1, "x", "a", 5.0, None, "West", None, 1), (1, None, "b", None, 6.0, "East", None, 2)],
        META + ", n int",
    )
    found = merge.upsert_metadata(stored, batch, AS_OF, arrival="n").first()
    assert tuple(found)[1:6] == (None, "b", 5.0, 6.0, "East")


def test_marks(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    stored = spark.createDataFrame(
        [(1, late, late), (2, late, late)],
        "sensor_id long, last_data_datetime_utc timestamp_ntz, last_run_time timestamp",
    )
    latest = spark.createDataFrame(
        [(1, early), (3, early)], "sensor_id long, last_data_datetime_utc timestamp_ntz"
    )

    def marks(df):
        return {r["sensor_id"]: r["last_data_datetime_utc"] for r in df.collect()}

    assert marks(merge.upsert_signal(stored, latest, AS_OF)) == {1: early, 2: late, 3: early}
    forward = merge.upsert_signal(stored, latest, AS_OF, forward_only=True)
    assert marks(forward) == {1: late, 2: late, 3: early}
    asked = spark.createDataFrame([(1,), (9,)], "sensor_id long")
    start = {
        r["sensor_id"]: r["start"]
        for r in merge.signal_windows(stored, asked, dt.datetime(2020, 1, 1)).collect()
    }
    assert start == {1: late, 9: dt.datetime(2020, 1, 1)}
