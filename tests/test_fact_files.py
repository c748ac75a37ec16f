"""How facts lie in files: dealt by key, sorted by sensor, counted by the tasks that write them."""

import datetime as dt
import os
import re
import subprocess
import sys
import textwrap

from conftest import ROOT
from pyspark.sql import functions as F

from hazeline.operators import merge
from hazeline.schemas import FACT, KEY
from hazeline.sources.landing import ARRIVAL
from hazeline.sources.tables import CommitLog, FactTable

DAY = dt.datetime(2024, 1, 5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above(text, marker):
    """The operators between the root and the line with a marker."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth, found = len(re.match(r"[\s:|+-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        indent = len(re.match(r"[\s:|+-]*", line)[0])
        if indent < depth and line.strip():
            depth = indent
            found.append(line.strip())
    return found


def readings(spark, sensors, hours):
    """One row per sensor and hour."""
    rows = spark.range(sensors * hours)
    hour = F.expr(f"cast(id div {sensors} as int)")
    stamp = F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)
    made = {
        "sensor_id": F.col("id") % sensors,
        "parameter": F.concat(F.lit("pm"), F.when(F.col("id") >= 0, "25")),
        "datetime_utc": stamp,
        "datetime_local": stamp,
        "value": F.col("id").cast("double"),
    }
    return rows.select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FACT])


def test_merge_moves_the_batch_only(spark, folder):
    table = FactTable(spark, f"{folder}/facts", buckets=5)
    table.append(readings(spark, 40, 30), "a")
    batch = readings(spark, 50, 40).withColumns({c: F.lit(0) for c in ARRIVAL[1:]}).withColumn(ARRIVAL[0], F.lit("f"))
    span = {"2024-01": (DAY, DAY + dt.timedelta(days=9))}
    with table.dealt(span, skip_batch="b") as stored:
        marked = merge.marked_rows(stored, batch, ARRIVAL, parts=table.buckets)
        path = above(plan(marked), "Bucketed: true")
        assert any("Join" in line for line in path)
        join = next(i for i, line in enumerate(path) if "Join" in line)
        assert not [line for line in path[:join] if "Exchange" in line]
        # Aggregated, joined and ready to be written, without another exchange above.
        assert not [line for line in path if "Exchange" in line]
        assert marked.groupBy("stored").count().orderBy("stored").collect() == [(False, 800), (True, 1200)]
        inserted = table.append(marked.where("not stored"), "b", dealt=True)
    assert inserted == 800 and table.read().count() == 2000
    assert table.read().select(*KEY).distinct().count() == 2000
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("hazeline_")]
    # Every file of a bucket has the rows of that bucket; the number is the table's for good.
    assert FactTable(spark, f"{folder}/facts", buckets=3).buckets == 5
    where = table.read().select("sensor_id", "parameter", "datetime_utc", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).cast("int").alias("file"))
    assert where.where(F.pmod(F.hash(*KEY), F.lit(5)) != F.col("file")).count() == 0


def test_stored_rows_by_range_and_batch(spark, folder, rows):
    table = FactTable(spark, f"{folder}/facts")
    table.append(readings(spark, 3, 48), "a")
    table.append(readings(spark, 1, 72).withColumn("datetime_utc", F.col("datetime_utc") + F.expr("interval 30 days")), "b")
    span = {"2024-01": (DAY, DAY + dt.timedelta(hours=1))}
    for skip in (None, "a"):
        with table.dealt(span, skip_batch=skip) as stored:
            assert rows(stored, *KEY) == rows(table.read(span, skip_batch=skip), *KEY)
    assert table.read(span).count() == 6 and table.read(span, skip_batch="a").count() == 0


def test_one_sensor_skips_row_groups(spark, folder):
    """Rows lie by sensor inside a file, so statistics tell which row groups have one."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "8192")
    conf.set("parquet.page.size", "1024")
    try:
        table = FactTable(spark, f"{folder}/facts", buckets=2)
        table.append(readings(spark, 400, 100), "a")
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size")
    one = table.read().where("sensor_id = 123").select("value")
    assert one.count() == 100
    one.collect()
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numOutputRows").get().value() < 40_000 / 10


def test_log_stays_short(spark, folder, monkeypatch):
    """A reader opens the last whole state and the commits after it; compacted months are one entry."""
    monkeypatch.setattr(CommitLog, "FOLD", 4)
    table = FactTable(spark, f"{folder}/facts", buckets=2)
    for number in range(6):
        table.append(readings(spark, 2, 2), f"b{number}")
        again = FactTable(spark, f"{folder}/facts")
        assert sorted(map(str, again.log.entries())) == sorted(map(str, table.log.entries()))
        assert len(again.log._folders()) <= 4
    assert sum(e.month is not None for e in table.log.entries()) == 6
    before = table.read().count()
    table.compact(["2024-01"])
    entries = FactTable(spark, f"{folder}/facts").log.entries()
    assert sum(e.month is not None for e in entries) == 1 and sum(e.batch is not None for e in entries) == 6
    assert table.read().count() == before and table.rows_in_batch("b3") == 4
    table.append(readings(spark, 1, 1), "c")
    assert FactTable(spark, f"{folder}/facts").read().count() == before + 1


def test_counts_are_exact_though_tasks_fail(folder):
    """Tasks of the writing stage fail after some rows and run again: rows and duplicates count once."""
    script = f"""
        import sys
        sys.path[:0] = [{ROOT!r}, {os.path.join(ROOT, "tests")!r}]
        from pyspark import TaskContext
        from hazeline import build_session
        from hazeline.plans import ingest
        from hazeline.sources.tables import FactTable
        from test_ingest import land, result
        from hazeline.sources.landing import read_pages

        base = {folder!r}
        spark = build_session("local[2,3]", **{{"spark.sql.shuffle.partitions": "3", "spark.checkpoint.dir": base}})
        land(f"{{base}}/one", [{{"sensor_id": 1, "results": [result(d, d) for d in range(1, 20)]}}])
        land(f"{{base}}/two", [{{"sensor_id": 1, "results": [result(d, d) for d in range(10, 28)]}}])
        facts = FactTable(spark, f"{{base}}/facts", buckets=4)
        plain = ingest.marked_rows

        def failing(*args, **kwargs):
            marked = plain(*args, **kwargs)

            def fail_once(batches):
                for batch in batches:
                    yield batch
                if TaskContext.get().attemptNumber() == 0:
                    raise RuntimeError("lost")

            return marked.mapInArrow(fail_once, marked.schema)

        ingest.marked_rows = failing
        for name in ("one", "two"):
            stats = ingest.ingest_batch(spark, read_pages(spark, f"{{base}}/{{name}}"), facts, name, f"{{base}}/stage")
            print("STATS", stats.attempted, stats.inserted, stats.duplicates, facts.rows_in_batch(name))
        print("ROWS", facts.read().count())
    """
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    told = [line for line in run.stdout.split("\n") if line.startswith(("STATS", "ROWS"))]
    assert told == ["STATS 19 19 0 19", "STATS 18 8 10 8", "ROWS 27"]
