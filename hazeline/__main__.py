"""Jobs to submit: ``spark-submit … -m hazeline <job>`` or ``python -m hazeline <job>``.

All tables lie below one root folder: the fact table in ``sensor_data``, the
sensor map in ``sensor_map``, staged batches in ``stage``.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators.filters import SCENARIO_THRESHOLDS, requested_locations
from hazeline.functions.numbers import to_id
from hazeline.functions.text import region_overrides
from hazeline.operators.merge import (
    latest_per_sensor,
    signal_windows,
    upsert_metadata,
    upsert_signal,
)
from hazeline.operators.places import Directory
from hazeline.plans import ingest
from hazeline.plans.loading import Selection
from hazeline.plans.reports import TREND_CITIES, Scope
from hazeline.plans.suite import REPORTS, run_suite
from hazeline.schemas import SENSOR_METADATA, SIGNAL
from hazeline.session import tune
from hazeline.sources.dimensions import read_coords, read_locations, read_sensor_map
from hazeline.sources.exports import export_by_sensor, export_counts
from hazeline.sources.landing import (
    broken_lines,
    read_location_pages,
    read_page_stream,
    read_sensor_pages,
)
from hazeline.sources.tables import BUCKETS, FactTable, SnapshotTable, ensure_tables, scan_parameter
from hazeline.streaming import jobs


# Where reading starts for a sensor without a mark.
DEFAULT_MARK = dt.datetime(2024, 1, 1)


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="hazeline", description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--locations", help="CSV of State,Code,City")
    parser.add_argument("--coords", help="CSV of location_id,latitude,longitude")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="files a month, when the fact table is new")
    sub = parser.add_subparsers(dest="job", required=True)
    sub.add_parser("create-tables", help="create the catalog tables that are missing")
    for name in ("scheduled", "backfill", "stream"):
        job = sub.add_parser(name, help=f"{name} ingest of landed pages")
        job.add_argument("--pages", required=True, help="landed measurement pages")
        job.add_argument("--location-pages", required=True, help="landed location pages")
        job.add_argument("--location-ids", help="comma-separated ids instead of the CSV's")
        job.add_argument("--start", default=ingest.DEFAULT_START)
        job.add_argument("--end")
        job.add_argument("--merge-map", action="store_true", help="keep map entries of other sensors")
        if name == "stream":
            job.add_argument("--source", default="stream", help="name of the stream in the table")
        else:
            job.add_argument("--batch", required=True, help="name; a rerun replaces itself")
    report = sub.add_parser("report", help="write all reports as small tables")
    report.add_argument("--out", required=True)
    report.add_argument("--parameter", default="pm25")
    report.add_argument("--cities", type=int, default=TREND_CITIES, help="cities in the trend")
    report.add_argument("--start", type=_date)
    report.add_argument("--end", type=_date)
    report.add_argument("--state", action="append", default=[])
    report.add_argument("--city", action="append", default=[])
    report.add_argument("--scenario", choices=list(SCENARIO_THRESHOLDS))
    report.add_argument("--only", action="append", choices=list(REPORTS))
    sub.add_parser("signal", help="set each sensor's mark to its latest time")
    windows = sub.add_parser("windows", help="where to start reading for each mapped sensor")
    windows.add_argument("--out", required=True)
    windows.add_argument("--default-start", type=dt.datetime.fromisoformat, default=DEFAULT_MARK)
    metadata = sub.add_parser("metadata", help="update sensor metadata from landed records")
    metadata.add_argument("--pages", required=True, help="landed sensor records")
    metadata.add_argument("--regions", default="", help="overrides, as 3:North,8:South")
    compact = sub.add_parser("compact", help="rewrite months of the fact table")
    compact.add_argument("--month", action="append", required=True, help="yyyy-MM")
    export = sub.add_parser("export", help="CSV files by sensor")
    export.add_argument("--out", required=True)
    return parser


def _directory(spark: SparkSession, args) -> Directory:
    return Directory(
        read_sensor_map(spark, f"{args.root}/sensor_map"),
        read_locations(spark, args.locations),
        read_coords(spark, args.coords) if args.coords else None,
    )


def _ingest(spark: SparkSession, args, facts: FactTable) -> DataFrame | None:
    known = read_locations(spark, args.locations) if args.locations else None
    pages = read_location_pages(spark, args.location_pages)
    if known is None:
        known = pages.select(to_id(F.col("id")).alias("location_id")).dropna()
    requested = requested_locations(spark, args.location_ids, known)
    coords = read_coords(spark, args.coords) if args.coords else None
    if args.job == "stream":
        jobs.start_ingest(
            spark,
            read_page_stream(spark, args.pages),
            facts,
            f"{args.root}/stage",
            f"{args.root}/checkpoint",
            args.source,
            ingest.requested_sensors(pages, requested),
            coords,
            start=args.start,
            end=args.end,
        ).awaitTermination()
        return None
    run = ingest.backfill_run if args.job == "backfill" else ingest.scheduled_run
    return run(
        spark,
        args.pages,
        pages,
        requested,
        coords,
        facts,
        args.batch,
        f"{args.root}/stage",
        args.start,
        args.end,
        f"{args.root}/sensor_map",
        merge_map=args.merge_map,
    )


def _update_metadata(spark: SparkSession, args) -> int:
    """New snapshot of the metadata; returns the number of broken lines."""
    pages = read_sensor_pages(spark, args.pages)
    overrides = region_overrides(spark, args.regions)
    records = ingest.sensor_metadata_records(pages, overrides)
    table = SnapshotTable(spark, f"{args.root}/sensor_metadata", SENSOR_METADATA)
    records = records.withColumn("arrival", F.monotonically_increasing_id())
    table.replace(upsert_metadata(table.read(), records, _now(), arrival="arrival"))
    return broken_lines(pages).count()


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def main(argv: list[str] | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"hazeline {args.job}").getOrCreate())
    facts = FactTable(spark, f"{args.root}/sensor_data", args.buckets)
    if args.job == "create-tables":
        print("\n".join(ensure_tables(spark, args.root)))
    elif args.job in ("scheduled", "backfill", "stream"):
        result = _ingest(spark, args, facts)
        print(result.first().asDict() if isinstance(result, DataFrame) else result)
    elif args.job == "report":
        threshold = SCENARIO_THRESHOLDS[args.scenario] if args.scenario else None
        selection = Selection(args.start, args.end, args.state, args.city, threshold)
        rows = scan_parameter(facts.read(), args.parameter)
        scope = Scope(rows, _directory(spark, args), selection)
        run_suite(spark, scope, args.out, args.only or tuple(REPORTS), trend_cities=args.cities)
    elif args.job == "signal":
        signal = SnapshotTable(spark, f"{args.root}/signal_table", SIGNAL)
        latest = latest_per_sensor(facts.read())
        signal.replace(upsert_signal(signal.read(), latest, _now()))
    elif args.job == "windows":
        signal = SnapshotTable(spark, f"{args.root}/signal_table", SIGNAL)
        sensors = read_sensor_map(spark, f"{args.root}/sensor_map")
        starts = signal_windows(signal.read(), sensors, args.default_start)
        starts.write.mode("overwrite").parquet(args.out)
    elif args.job == "metadata":
        print(f"broken lines: {_update_metadata(spark, args)}")
    elif args.job == "compact":
        facts.compact(args.month)
    elif args.job == "export":
        rows = facts.read().drop("created_at", "month", "batch")
        export_by_sensor(rows, args.out)
        requested = read_sensor_map(spark, f"{args.root}/sensor_map")
        print(export_counts(requested, rows).first().asDict())


if __name__ == "__main__":
    main()
