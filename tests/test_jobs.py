"""The submitted jobs, end to end on a small landing."""

import os

import pytest
from test_ingest import FIRST, LOCATIONS, SECOND, land, stored

from hazeline.__main__ import main
from hazeline.plans.suite import REPORTS
from hazeline.schemas import SENSOR_METADATA, SIGNAL
from hazeline.sources.dimensions import read_sensor_map
from hazeline.sources.tables import FactTable, SnapshotTable

CSV = "State,Code,City\nMaine,100,Portland\nOhio,200,Dayton\nUtah,300,Provo\n"


@pytest.fixture
def base(folder):
    land(f"{folder}/first", FIRST)
    land(f"{folder}/second", SECOND)
    land(f"{folder}/locations", LOCATIONS)
    with open(f"{folder}/places.csv", "w") as out:
        out.write(CSV)
    return folder


def job(base, *arguments):
    main(["--root", f"{base}/root", "--locations", f"{base}/places.csv", *arguments])


def test_jobs(spark, base, capsys):
    pages = ["--location-pages", f"{base}/locations"]
    job(base, "scheduled", "--pages", f"{base}/first", *pages, "--batch", "a")
    assert "inserted=2" in capsys.readouterr().out
    job(base, "backfill", "--pages", f"{base}/second", *pages, "--batch", "b",
        "--location-ids", "100", "--end", "2/28/2024")
    out = capsys.readouterr().out
    # The backfill keeps the record's own name, which is the same here.
    assert "'total_rows_inserted': 2" in out and "'total_locations': 1" in out
    facts = FactTable(spark, f"{base}/root/sensor_data")
    assert len(stored(facts)) == 4

    job(base, "signal")
    signal = SnapshotTable(spark, f"{base}/root/signal_table", SIGNAL).read().first()
    assert (signal["sensor_id"], signal["last_data_datetime_utc"].month) == (1, 2)

    job(base, "report", "--out", f"{base}/out", "--state", "Maine", "--start", "2024-01-02")
    assert set(REPORTS) <= set(os.listdir(f"{base}/out"))
    kpis = spark.read.parquet(f"{base}/out/kpis").first()
    assert tuple(kpis)[::3] == (1, 3)
    job(base, "report", "--out", f"{base}/some", "--only", "kpis", "--only", "seasonal")
    assert set(os.listdir(f"{base}/some")) == {"cube", "kpis", "seasonal"}

    job(base, "report", "--out", f"{base}/ozone", "--only", "kpis", "--parameter", "o3")
    assert spark.read.parquet(f"{base}/ozone/kpis").first()["rows"] == 0

    job(base, "windows", "--out", f"{base}/windows")
    starts = {r["sensor_id"]: r["start"].month for r in spark.read.parquet(f"{base}/windows").collect()}
    assert starts == {1: 2}
    job(base, "compact", "--month", "2024-01")
    assert len(stored(facts)) == 4

    job(base, "export", "--out", f"{base}/csv")
    assert "'successful': 1" in capsys.readouterr().out
    assert "sensor_id=1" in os.listdir(f"{base}/csv")


def test_map_keeps_other_sensors_if_asked(spark, base):
    pages = ["--location-pages", f"{base}/locations"]
    job(base, "scheduled", "--pages", f"{base}/first", *pages, "--batch", "a")
    path = f"{base}/root/sensor_map"
    few = ["--pages", f"{base}/second", *pages, "--location-ids", "100"]
    job(base, "backfill", *few, "--batch", "b", "--merge-map")
    assert {r["sensor_id"] for r in read_sensor_map(spark, path).collect()} == {1, 3}
    job(base, "backfill", *few, "--batch", "c")
    assert {r["sensor_id"] for r in read_sensor_map(spark, path).collect()} == {1}


def test_metadata_job(spark, base, capsys):
    records = [
        {"id": 1, "name": "a", "parameter": {"name": "pm25"},
         "latest": {"coordinates": {"latitude": 1.5, "longitude": -110.0}},
         "datetime_last": {"utc": "2024-01-02T00:00:00Z"}},
        {"id": "2", "name": "b", "latest": {"coordinates": {"latitude": "x", "longitude": -80}}},
        '{"id": 3, "na',
    ]
    land(f"{base}/records", records)
    for _ in range(2):
        job(base, "metadata", "--pages", f"{base}/records", "--regions", "2:Coast")
    assert "broken lines: 1" in capsys.readouterr().out
    table = SnapshotTable(spark, f"{base}/root/sensor_metadata", SENSOR_METADATA).read()
    found = {r["sensor_id"]: (r["latitude"], r["region"]) for r in table.collect()}
    assert found == {1: (1.5, "West"), 2: (None, "Coast")}


def test_stream_job(spark, base):
    pages = ["--location-pages", f"{base}/locations"]
    for _ in range(2):
        job(base, "stream", "--pages", f"{base}/first", *pages)
    assert len(stored(FactTable(spark, f"{base}/root/sensor_data"))) == 2
