"""Readers, tables and exports."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from hazeline.operators.cleaning import is_unstorable, prepare_measurements
from hazeline.schemas import FACT, SIGNAL
from hazeline.sources import exports, relational
from hazeline.sources.dimensions import read_coords, read_locations, read_sensor_map
from hazeline.sources.exports import (
    build_sensor_map,
    export_by_sensor,
    export_counts,
    read_export,
    write_sensor_map,
)
from hazeline.sources.landing import (
    BACKFILL,
    broken_lines,
    flatten_pages,
    location_sensors,
    read_location_pages,
    read_measurement_pages,
    read_pages,
)
from hazeline.sources.tables import (
    FactTable,
    UsedBatchName,
    SnapshotTable,
    ensure_tables,
    scan_parameter,
    table_exists,
)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


def test_locations_csv(spark, folder, rows):
    path = write(
        f"{folder}/l.csv",
        "State,Code,City\r\nAlabama,1671,Montgomery\r\nMassachusetts,8786,Lowell\r\n"
        "Ohio,,Dayton\r\nOhio,abc,Dayton\r\nIowa,12,\r\nNew Hampshire,8786,Manchester\r\n",
    )
    assert rows(read_locations(spark, path)) == [
        (1671, "Alabama", "Montgomery"), (8786, "New Hampshire", "Manchester")
    ]


def test_sensor_map_csv(spark, folder, rows):
    path = write(f"{folder}/m.csv", "sensor_id,location_id\n1,10\n2,\n1,11\n3.0,30\n")
    assert rows(read_sensor_map(spark, path)) == [(1, 11), (3, 30)]


def test_coords_csv(spark, folder, rows):
    text = "name,location_id,latitude,longitude\na,1,10.5,-20.5\nb,2,,3\nc,3,x,3\nd,1,11,-21\n"
    path = write(f"{folder}/c.csv", text)
    assert rows(read_coords(spark, path)) == [(1, 11.0, -21.0)]
    absent = read_coords(spark, f"{folder}/absent.csv")
    assert absent.count() == 0 and absent.columns == ["location_id", "latitude", "longitude"]


PAGES = """\
{"sensor_id": 1, "results": [{"value": 1.5, "parameter": {"name": "PM25", "units": "x"}, \
"period": {"datetime_from": {"utc": "2024-01-01T05:00:00Z", "local": "2024-01-01T00:00:00-05:00"}}, \
"coverage": {"percent_complete": 75}, "summary": {"min": 1, "max": 2, "median": 1.5}, \
"coordinates": {"latitude": 3, "longitude": 4}}, \
{"value": "bad", "parameter": {"name": "o3"}, \
"period": {"datetime_from": {"utc": "2024-01-02T05:00:00Z", "local": "2024-01-02T00:00:00-05:00"}}}]}
{"sensor_id": 2, "results": []}
{"sensor_id": 3, "results": [{"value":
"""


def test_pages(spark, folder):
    path = os.path.dirname(write(f"{folder}/pages/p.json", PAGES))
    got = prepare_measurements(read_measurement_pages(spark, path, BACKFILL)).orderBy("arrival_pos")
    first, second = got.select(*FACT.names).collect()
    utc, local = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1)
    assert tuple(first) == (1, "PM25", utc, local, 1.5, "x", 75.0, 1.0, 2.0, 1.5, 3.0, 4.0)
    assert tuple(second)[4:] == (None,) * 8
    names = {r[0] for r in read_measurement_pages(spark, path).select("parameter").collect()}
    assert names == {"pm25"}
    everything = prepare_measurements(flatten_pages(read_pages(spark, path)))
    bad = everything.where(is_unstorable(everything)).collect()
    assert len(bad) == 1 and bad[0]["corrupt_line"].startswith('{"sensor_id": 3')


def test_arrival_order_within_a_file(spark, folder):
    line = '{{"sensor_id": {}, "results": [{{"value": 1}}, {{"value": 2}}]}}\n'
    path = os.path.dirname(write(f"{folder}/p/a.json", "".join(line.format(i) for i in range(50))))
    got = flatten_pages(read_pages(spark, path)).orderBy(
        "arrival_file", "arrival_block", "arrival_line", "arrival_pos"
    )
    assert [(int(r["sensor_id"]), int(r["value"])) for r in got.collect()] == [
        (i, v) for i in range(50) for v in (1, 2)
    ]


def test_location_pages(spark, folder, rows):
    text = (
        '{"id": 10, "sensors": [{"id": 1, "name": "a", "parameter": {"name": "PM25"}, '
        '"coordinates": {"latitude": 1, "longitude": 2}}, {"id": 2, "parameter": {"name": "o3"}}, '
        '{"id": 3}]}\n{"id": 20, "sensors": []}\n{"id": 30}\n'
    )
    path = os.path.dirname(write(f"{folder}/loc/p.json", text))
    sensors = location_sensors(read_location_pages(spark, path))
    assert rows(sensors, "location_id", "sensor_id", "latitude") == [(10, 1, 1.0)]
    assert location_sensors(read_location_pages(spark, path), only_pm25=False).count() == 3


def facts(spark, data):
    made = [
        (s, "pm25", t, t, v, "x", None, None, None, None, None, None) for s, t, v in data
    ]
    return spark.createDataFrame(made, FACT)


def test_fact_table(spark, folder, rows):
    table = FactTable(spark, f"{folder}/facts")
    assert table.read().count() == 0
    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    table.append(facts(spark, [(1, jan, 1.0), (2, feb, 2.0)]), "a")
    table.append(facts(spark, [(3, feb, 3.0)]), "b", "two files")
    assert table.append(facts(spark, [(3, feb, 3.0)]), "b", "two files") == 1
    with pytest.raises(UsedBatchName, match="other input"):
        table.append(facts(spark, [(4, feb, 3.0)]), "b", "another file")
    assert rows(table.read(), "sensor_id", "month", "batch") == [
        (1, "2024-01", "a"), (2, "2024-02", "a"), (3, "2024-02", "b")
    ]
    assert table.rows_in_batch("a") == 2 and table.rows_in_batch("b") == 1
    pruned = table.read({"2024-02": (feb, feb)}, skip_batch="a")
    assert rows(pruned, "sensor_id") == [(3,)]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month", plan)
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(datetime_utc", plan)
    # A shorter rerun leaves no month behind.
    table.append(facts(spark, [(1, jan, 1.0)]), "a")
    assert rows(table.read(), "sensor_id", "batch") == [(1, "a"), (3, "b")]
    assert table.read({"2024-02": (feb, feb)}, skip_batch="b").count() == 0
    table.compact(["2024-02"])
    assert rows(table.read(), "sensor_id", "batch") == [(1, "a"), (3, "b")]
    assert table.rows_in_batch("b") == 1
    with pytest.raises(UsedBatchName, match="compacted"):
        table.append(facts(spark, [(3, feb, 3.0)]), "b", "two files")
    table.append(facts(spark, []), "empty", "no rows")
    with pytest.raises(UsedBatchName):
        table.append(facts(spark, []), "empty", "other rows")
    with pytest.raises(ValueError, match="lacks columns"):
        table.append(facts(spark, []).drop("units"), "c")


def test_scan_parameter_cleans_nan(spark):
    df = facts(spark, [(1, dt.datetime(2024, 1, 1), float("nan"))])
    got = scan_parameter(df).first()
    assert got["value"] is None and "coverage_percent" not in got.asDict()


def test_snapshot_survives_a_dead_writer(spark, folder):
    table = SnapshotTable(spark, f"{folder}/signal", SIGNAL)
    assert table.read().count() == 0
    now = dt.datetime(2024, 1, 1)
    table.replace(spark.createDataFrame([(1, now, now)], SIGNAL))
    os.makedirs(f"{folder}/signal/v=2")
    write(f"{folder}/signal/v=2/part-0.parquet", "half a file")
    assert table.version() == 1 and table.read().count() == 1
    table.replace(table.read().unionByName(spark.createDataFrame([(2, now, now)], SIGNAL)))
    assert table.version() == 2 and table.read().count() == 2


def test_tables_in_the_catalog(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS air LOCATION '{folder}/air'")
    assert not table_exists(spark, "air.sensor_data")
    for _ in range(2):
        names = ensure_tables(spark, f"{folder}/tables", "air")
    assert all(table_exists(spark, name) for name in names) and len(names) == 3
    spark.sql("DROP DATABASE air CASCADE")


def test_export_by_sensor(spark, folder):
    df = facts(spark, [(i % 3, dt.datetime(2024, 1, 1 + i), float(i)) for i in range(9)])
    export_by_sensor(df, f"{folder}/csv")
    assert {d for d in os.listdir(f"{folder}/csv") if "=" in d} == {
        f"sensor_id={i}" for i in range(3)
    }
    back = spark.read.option("header", True).csv(f"{folder}/csv")
    assert back.count() == 9 and "datetime_utc" in back.columns
    asked = spark.createDataFrame([(0,), (1,), (7,)], "sensor_id long")
    assert tuple(export_counts(asked, df).first()) == (2, 1, 3)


def _exported(path):
    """Sorted lines of all files by folder; a file without its header fails."""
    found = {}
    for folder in (d for d in os.listdir(path) if "=" in d):
        lines = found[folder] = []
        for name in (n for n in os.listdir(f"{path}/{folder}") if not n.startswith(".")):
            with open(f"{path}/{folder}/{name}", newline="") as file:
                header, *rest = file.read().split("\n")
            assert header == '"a,b",n,at,d' and rest.pop() == ""
            lines += rest
        lines.sort()
    return found


def test_export_is_what_spark_writes(spark, folder):
    at, day = dt.datetime(2024, 1, 1, 2, 3, 4, 5000), dt.date(2024, 2, 3)
    texts = ["x", "", None, ' a "b", c ', "two\nlines", "back\\slash", "µg", "#", "\r\t"]
    sensors = ["7", None, "a/b=c%d", "e f:g[h]^{i}*", "ü'?\"#\x01\x7f\\"]
    rows = [(s, t, float(i) * 1e9, at, day) for s in sensors for i, t in enumerate(texts)]
    rows += [("8", None, None, None, None), ("8", None, float("nan"), at, None)]
    schema = "sensor_id string, `a,b` string, n double, at timestamp_ntz, d date"
    df = spark.createDataFrame(rows, schema)
    df.write.option("header", True).partitionBy("sensor_id").csv(f"{folder}/spark")
    export_by_sensor(df, f"{folder}/own")
    assert _exported(f"{folder}/own") == _exported(f"{folder}/spark")
    assert os.path.exists(f"{folder}/own/_SUCCESS")
    one = spark.createDataFrame([(1, None), (1, ""), (2, "x")], "sensor_id long, t string")
    one.write.option("header", True).partitionBy("sensor_id").csv(f"{folder}/spark1")
    export_by_sensor(one, f"{folder}/own")
    back = [spark.read.option("header", True).csv(f"{folder}/{p}") for p in ("spark1", "own")]
    assert sorted(map(str, back[0].collect())) == sorted(map(str, back[1].collect()))


def test_export_makes_one_file_a_sensor_and_no_other(spark, folder):
    """Checksums and folders made by Hadoop cost a process each."""
    df = facts(spark, [(i % 40, dt.datetime(2024, 1, 1 + i % 9), float(i)) for i in range(400)])
    export_by_sensor(df, f"file:{folder}/csv")
    for i in range(40):
        [name] = os.listdir(f"{folder}/csv/sensor_id={i}")
        assert re.fullmatch(r"part-.*\.csv", name)


def test_export_splits_large_sensors(spark, folder, monkeypatch):
    monkeypatch.setattr(exports, "ROWS_PER_FILE", 2)
    df = facts(spark, [(i % 2, dt.datetime(2024, 1, 1 + i), float(i)) for i in range(10)])
    export_by_sensor(df, f"{folder}/csv")
    assert [len(os.listdir(f"{folder}/csv/sensor_id={i}")) for i in range(2)] == [3, 3]
    back = read_export(spark, f"{folder}/csv", df.schema)
    assert sorted(r["value"] for r in back.collect()) == [float(i) for i in range(10)]
    assert back.schema["sensor_id"].dataType == df.schema["sensor_id"].dataType


def test_export_without_rows(spark, folder):
    df = facts(spark, [(1, dt.datetime(2024, 1, 1), 1.0)]).where("false")
    export_by_sensor(df, f"{folder}/csv")
    asked = spark.createDataFrame([(0,), (1,)], "sensor_id long")
    assert tuple(export_counts(asked, read_export(spark, f"{folder}/csv", df.schema)).first()) == (0, 2, 2)


def test_export_is_read_with_few_tasks(spark, folder):
    """Folders are listed once, and not by a task each."""
    df = facts(spark, [(i, dt.datetime(2024, 1, 1), 1.0) for i in range(300)])
    export_by_sensor(df, f"{folder}/csv")
    spark.sparkContext.setJobGroup("reading", "")
    back = read_export(spark, f"{folder}/csv", df.schema)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("reading")
    spark.sparkContext.setJobGroup("other", "")
    assert len(jobs) <= 1
    assert back.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_sensor_map_sink(spark, folder, rows):
    listed = spark.createDataFrame(
        [(2, 20, 1), (1, 10, 2), (2, 21, 3)], "sensor_id long, location_id long, n int"
    )
    write_sensor_map(build_sensor_map(listed, ["n"]), f"{folder}/map")
    assert rows(read_sensor_map(spark, f"{folder}/map")) == [(1, 10), (2, 21)]
    fresh = spark.createDataFrame([(3, 30), (1, 11)], "sensor_id long, location_id long")
    write_sensor_map(fresh, f"{folder}/map", merge=True)
    assert rows(read_sensor_map(spark, f"{folder}/map")) == [(1, 11), (2, 21), (3, 30)]
    write_sensor_map(fresh, f"{folder}/map")
    assert rows(read_sensor_map(spark, f"{folder}/map")) == [(1, 11), (3, 30)]


def test_last_listed_location_wins(spark, folder, rows):
    """Two pages list sensor 7, the second at the smaller location; a line is broken."""
    page = '{{"id": "{}", "sensors": [{{"id": 7, "parameter": {{"name": "pm25"}}}}]}}\n'
    path = os.path.dirname(write(f"{folder}/loc/p.json", page.format(9) + page.format(2) + '{"id": 3, "se\n'))
    pages = read_location_pages(spark, path)
    assert rows(build_sensor_map(location_sensors(pages))) == [(7, 2)]
    assert broken_lines(pages).count() == 1


def test_quoted_location_id_keeps_the_page(spark, folder):
    text = '{"sensor_id": 1, "location_id": "17", "results": [{"value": 5}]}\n'
    path = os.path.dirname(write(f"{folder}/m/p.json", text))
    row = read_measurement_pages(spark, path).first()
    assert (row["location_id"], row["value"]) == (17, "5")


def test_database_ignores_known_rows():
    text = relational.insert_statement("sensor_data", "incoming")
    assert text.startswith('INSERT INTO sensor_data ("sensor_id", "parameter", "datetime_utc"')
    assert text.endswith('ON CONFLICT ("sensor_id", "parameter", "datetime_utc") DO NOTHING')


def test_relational_options():
    options = relational.connection("db", "air", "me", "secret")
    assert options["url"] == "jdbc:postgresql://db:5432/air?sslmode=require"
    with pytest.raises(ValueError):
        relational.connection("db", "air", "", "secret")
    assert relational.month_predicates(["2024-12", "2024-01"]) == [
        "datetime_utc >= '2024-01-01' AND datetime_utc < '2024-02-01'",
        "datetime_utc >= '2024-12-01' AND datetime_utc < '2025-01-01'",
    ]


def test_bad_keys_are_unstorable(spark):
    when = dt.datetime(2024, 1, 1)
    df = facts(spark, [(1, when, 1.0)]).unionByName(
        facts(spark, [(1, when, 1.0)]).withColumn("sensor_id", F.lit(None).cast("long"))
    )
    assert [r[0] for r in df.select(is_unstorable(df)).collect()] == [False, True]
