"""One entry per operator: a callable from (spark, sf_dir) to a DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions import categories
from hazeline.functions.dates import local_clock, to_iso_text, utc_clock
from hazeline.functions.numbers import to_number
from hazeline.functions.text import (
    is_pm25,
    location_list,
    looks_like_pm25,
    region_overrides,
)
from hazeline.operators import filters, merge
from hazeline.operators.cleaning import dedup_first, filter_range, prepare_measurements
from hazeline.operators.partials import mean
from hazeline.operators.places import assign_region, attach_to_sensors, enrich
from hazeline.plans import ingest, reports
from hazeline.plans.daily import daily_summary
from hazeline.plans.loading import Selection, filter_all, load_measurements, sensor_metadata
from hazeline.plans.reports import Scope
from hazeline.plans.suite import run_suite, with_cube, with_parts
from hazeline.queries import views
from hazeline.queries.views import DAILY_KEY, with_date
from hazeline.schemas import FACT, SIGNAL
from hazeline.session import work_dir
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
    location_sensors,
    read_location_pages,
    read_measurement_pages,
    read_page_stream,
    read_sensor_pages,
)
from hazeline.sources.tables import FactTable, SnapshotTable, scan_parameter
from hazeline.streaming import jobs

REGISTRY = {}

AS_OF = dt.datetime(2024, 2, 1)
OVERRIDES = "3:North, 8: South ,bad,x:y,12:,3:Coast"
LOCATION_LIST = "3, 7,11,, 24"
SELECTION = Selection(
    start=dt.date(2024, 1, 5),
    end=dt.date(2024, 1, 25),
    states=["ASIA", "EUROPE", "Unknown"],
    cities=["NATION_2", "NATION_3", "NATION_7", "NATION_8", "Location 21", "Location 49"],
    threshold=35,
)
SELECTED_CITIES = ["NATION_7", "NATION_1", "Location 49", "NATION_3", "NATION_9", "NATION_5"]
ROW = ["arrival", "sensor_id", "parameter", "datetime_utc", "value"]


def query(name):
    def register(run):
        REGISTRY[name] = run
        return run

    return register


def _six(df: DataFrame, *names: str) -> DataFrame:
    """Means to six places, as the last digits hang on the order of a sum."""
    return df.withColumns({name: F.round(name, 6) for name in names})


def _scope(spark: SparkSession, sf_dir: str, selection: Selection | None = None) -> Scope:
    return Scope(
        views.pm25(spark, sf_dir), views.places(spark, sf_dir), selection or Selection()
    )


def _shipment_scope(spark: SparkSession, sf_dir: str) -> Scope:
    return Scope(views.shipments(spark, sf_dir), views.places(spark, sf_dir))


# Sources and sinks


@query("ingest_flatten")
def _ingest_flatten(spark, sf_dir) -> DataFrame:
    landing = work_dir(spark, "landing")
    views.land_pages(views.table(spark, sf_dir, "events"), landing)
    views.land_broken(spark, f"{landing}/day=2024-01-01")
    rows = read_measurement_pages(spark, landing, BACKFILL)
    return prepare_measurements(rows).select(*FACT.names)


@query("json_props_extract")
def _json_props_extract(spark, sf_dir) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return events.select("event_id", k.alias("k"))


@query("dim_location_last_wins")
def _dim_location_last_wins(spark, sf_dir) -> DataFrame:
    landing = work_dir(spark, "places-csv")
    views.land_location_csv(spark, sf_dir, landing)
    return read_locations(spark, landing)


@query("dim_sensor_map")
def _dim_sensor_map(spark, sf_dir) -> DataFrame:
    landing = work_dir(spark, "map-csv")
    views.land_map_csv(spark, sf_dir, landing)
    return read_sensor_map(spark, landing)


@query("dim_coords_nonnull")
def _dim_coords_nonnull(spark, sf_dir) -> DataFrame:
    landing = work_dir(spark, "coords-csv")
    views.land_coords_csv(spark, sf_dir, landing)
    return read_coords(spark, landing)


@query("scan_parameter")
def _scan_parameter_pm25(spark, sf_dir) -> DataFrame:
    return scan_parameter(views.measurements(spark, sf_dir))


@query("export_counts")
def _export_counts_by_sensor(spark, sf_dir) -> DataFrame:
    """Counted over the files of the export."""
    out = work_dir(spark, "export")
    rows = views.pm25(spark, sf_dir)
    export_by_sensor(rows, out)
    return export_counts(views.sensor_map(spark, sf_dir), read_export(spark, out, rows.schema))


def _landed_sensors(spark, sf_dir, only_pm25: bool = True) -> DataFrame:
    landing = work_dir(spark, "locations")
    views.land_locations(spark, sf_dir, landing)
    return location_sensors(read_location_pages(spark, landing), only_pm25)


@query("sensor_map_build")
def _sensor_map_build(spark, sf_dir) -> DataFrame:
    """The map as its file has it."""
    out = work_dir(spark, "map")
    write_sensor_map(build_sensor_map(_landed_sensors(spark, sf_dir)), out)
    return read_sensor_map(spark, out)


@query("unnest_sensors")
def _unnest_sensors(spark, sf_dir) -> DataFrame:
    columns = ["location_id", "sensor_id", "sensor_name", "parameter", "latitude", "longitude"]
    return _landed_sensors(spark, sf_dir).select(*columns)


# Projections and filters


@query("coerce_numeric")
def _coerce_numeric(spark, sf_dir) -> DataFrame:
    text = F.when(F.col("event_id") % 41 == 0, "n/a").otherwise(F.col("value").cast("string"))
    return views.table(spark, sf_dir, "events").select("event_id", to_number(text).alias("value"))


@query("coerce_times")
def _coerce_times(spark, sf_dir) -> DataFrame:
    """Times as text with an offset; every forty-first is no time at all."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    text = F.when(F.col("event_id") % 41 == 0, "n/a").otherwise(text)
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        utc_clock(text).alias("datetime_utc"),
        local_clock(text).alias("datetime_local"),
    )


@query("ingest_date_range")
def _ingest_date_range(spark, sf_dir) -> DataFrame:
    rows = views.measurements(spark, sf_dir).select(*ROW)
    return filter_range(rows, "1/10/2024", "2024-01-16T12:00:00Z")


@query("param_exact")
def _param_exact(spark, sf_dir) -> DataFrame:
    return views.measurements(spark, sf_dir).select(*ROW).where(is_pm25(F.col("parameter")))


@query("param_fuzzy")
def _param_fuzzy(spark, sf_dir) -> DataFrame:
    rows = views.measurements(spark, sf_dir).select(*ROW)
    return rows.where(looks_like_pm25(F.col("parameter")))


@query("filter_date")
def _filter_date(spark, sf_dir) -> DataFrame:
    rows = views.measurements(spark, sf_dir).select(*ROW)
    return filters.filter_date(rows, dt.date(2024, 1, 5), dt.date(2024, 1, 12))


_PLACED = ["arrival", "sensor_id", "location_id", "state", "city", "value"]


@query("filter_state")
def _filter_state(spark, sf_dir) -> DataFrame:
    chosen = Selection(states=["ASIA", "Unknown"])
    return filter_all(views.pm25(spark, sf_dir), views.places(spark, sf_dir), chosen).select(*_PLACED)


@query("filter_city")
def _filter_city(spark, sf_dir) -> DataFrame:
    chosen = Selection(cities=SELECTED_CITIES)
    return filter_all(views.pm25(spark, sf_dir), views.places(spark, sf_dir), chosen).select(*_PLACED)


@query("scenario_watch")
def _scenario_watch(spark, sf_dir) -> DataFrame:
    rows = views.measurements(spark, sf_dir).select(*ROW)
    return filters.filter_scenario(rows, "AQI Watch (≥35 µg/m³)")


@query("scenario_severe")
def _scenario_severe(spark, sf_dir) -> DataFrame:
    rows = views.measurements(spark, sf_dir).select(*ROW)
    return filters.filter_scenario(rows, "Severe Episode (≥55 µg/m³)")


@query("coord_coverage")
def _coord_coverage(spark, sf_dir) -> DataFrame:
    return reports.coord_coverage(_scope(spark, sf_dir))


@query("date_bounds")
def _date_bounds(spark, sf_dir) -> DataFrame:
    return filters.date_bounds(views.measurements(spark, sf_dir))


@query("options_state")
def _options_state(spark, sf_dir) -> DataFrame:
    return filters.state_options(views.pm25(spark, sf_dir), views.places(spark, sf_dir))


@query("options_city")
def _options_city(spark, sf_dir) -> DataFrame:
    where = views.places(spark, sf_dir)
    return filters.city_options(views.pm25(spark, sf_dir), where, ["ASIA", "Unknown"])


# Joins


@query("enrich")
def _enrich_rows(spark, sf_dir) -> DataFrame:
    rows = enrich(views.pm25(spark, sf_dir), views.places(spark, sf_dir))
    return rows.drop("is_fallback", "latitude", "longitude")


@query("load_parameter_enriched")
def _load_parameter_enriched(spark, sf_dir) -> DataFrame:
    rows = load_measurements(views.measurements(spark, sf_dir), views.places(spark, sf_dir))
    return rows.drop("is_fallback", "latitude", "longitude")


@query("coords_priority")
def _coords_priority(spark, sf_dir) -> DataFrame:
    """Sensors as landed, some listed twice with other places."""
    even = F.col("event_id") % 2 == 0
    sensors = _landed_sensors(spark, sf_dir, only_pm25=False)
    rows = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("sensor_id"),
        F.when(even, 10.5).alias("latitude"),
        F.when(even, -20.5).alias("longitude"),
    )
    known = views.coords(spark, sf_dir)
    located = ingest.sensor_coords(sensors, known)
    joined = ingest.with_coords(rows, located, spread_by=["event_id"])
    return joined.select("event_id", "sensor_id", "latitude", "longitude")


@query("location_semi")
def _location_semi(spark, sf_dir) -> DataFrame:
    allowed = location_list(spark, LOCATION_LIST)
    return filters.filter_locations(views.sensor_map(spark, sf_dir), allowed)


@query("assign_region")
def _region_by_sensor(spark, sf_dir) -> DataFrame:
    sensors = views.measurements(spark, sf_dir).select("sensor_id").distinct()
    placed = attach_to_sensors(sensors, views.places(spark, sf_dir))
    rows = placed.select("sensor_id", "longitude")
    return assign_region(rows, region_overrides(spark, OVERRIDES))


# Reports


def _report(name, make, scope=_scope, means=()):
    REGISTRY[name] = lambda spark, sf_dir: _six(make(scope(spark, sf_dir)), *means)


_report("kpi", reports.kpis, means=["avg_pm25"])
_report("kpi_display", reports.kpi_display)
_report("map_agg", reports.map_sites, means=["avg_pm25", "radius"])
_report("map_center", reports.map_center, means=["latitude", "longitude"])
_report("top_locations", reports.top_locations)
_report("trend_top_cities", reports.trend_cities, means=["avg_pm25"])
_report("trend_daily", reports.trend_daily, means=["avg_pm25"])
_report("aqi_distribution", reports.aqi_distribution)
_report("aqi_rollup", reports.aqi_rollup)
_report("extreme_summary", reports.extreme_summary)
_report("extreme_top10", reports.extreme_top)
_report("weekday_weekend", reports.weekday_weekend, means=["mean"])
_report(
    "weekday_diff", reports.weekday_diff, means=["weekday_mean", "weekend_mean", "diff_pct"]
)
_report("seasonal", reports.seasonal, _shipment_scope, ["mean"])
_report("season_extremes", reports.season_extremes, _shipment_scope, ["worst_mean", "best_mean"])


@query("trend_daily_selected")
def _trend_daily_selected(spark, sf_dir) -> DataFrame:
    return _six(reports.trend_daily(_scope(spark, sf_dir), SELECTED_CITIES), "avg_pm25")


@query("map_display")
def _map_display(spark, sf_dir) -> DataFrame:
    table = reports.map_display(_scope(spark, sf_dir))
    return table.withColumn("colour", F.array_join("colour", ","))


@query("kpi_selected")
def _kpi_selected(spark, sf_dir) -> DataFrame:
    return _six(reports.kpis(_scope(spark, sf_dir, SELECTION)), "avg_pm25")


@query("weekday_weekend_selected")
def _weekday_weekend_selected(spark, sf_dir) -> DataFrame:
    return _six(reports.weekday_weekend(_scope(spark, sf_dir, SELECTION)), "mean")


@query("distribution_selected")
def _distribution_selected(spark, sf_dir) -> DataFrame:
    return reports.aqi_distribution(_scope(spark, sf_dir, SELECTION))


@query("report_cube")
def _report_cube(spark, sf_dir) -> DataFrame:
    cube = _scope(spark, sf_dir).build_cube()
    return _six(cube.withColumn("mean", mean()).drop("value_total"), "mean")


@query("report_suite")
def _report_suite(spark, sf_dir) -> DataFrame:
    """All reports written over one selection; what each column of each adds up to."""
    scope = _scope(spark, sf_dir, Selection(start=dt.date(2024, 1, 5), threshold=35))
    tables = run_suite(spark, scope, work_dir(spark, "suite"), selected_cities=SELECTED_CITIES)
    return ingest.union_batches([_column_totals(name, table) for name, table in tables.items()])


def _column_totals(name: str, table: DataFrame) -> DataFrame:
    """One row per column: rows, the sum of numbers, the least and the highest text."""
    rows, found = F.count(F.lit(1)).alias("n"), []
    for field in table.schema.fields:
        if field.dataType.simpleString() == "array<int>":
            continue
        column = F.col(field.name)
        text = field.dataType.simpleString() in ("string", "date")
        total = F.lit(None) if text else F.round(F.sum(F.round(column.cast("double"), 6)), 4)
        low, high = (f(column.cast("string")) if text else F.lit(None) for f in (F.min, F.max))
        found.append(
            F.struct(
                F.lit(field.name).alias("column"),
                total.cast("double").alias("total"),
                low.cast("string").alias("low"),
                high.cast("string").alias("high"),
            )
        )
    listed = table.agg(rows, F.array(*found).alias("columns"))
    return listed.select(F.lit(name).alias("report"), "n", F.inline("columns"))


@query("distribution_from_cube")
def _distribution_from_cube(spark, sf_dir) -> DataFrame:
    scope = _scope(spark, sf_dir, SELECTION)
    return reports.aqi_distribution(with_cube(spark, scope, work_dir(spark, "cube")))


@query("map_from_cube")
def _map_from_cube(spark, sf_dir) -> DataFrame:
    sites = reports.map_sites(with_cube(spark, _scope(spark, sf_dir), work_dir(spark, "cube")))
    return _six(sites, "avg_pm25", "radius")


def _parts(spark: SparkSession, sf_dir: str, selection: Selection | None = None) -> Scope:
    return with_parts(spark, _scope(spark, sf_dir, selection), work_dir(spark, "parts"))


def _selected_parts(spark: SparkSession, sf_dir: str) -> Scope:
    return _parts(spark, sf_dir, SELECTION)


_report("trend_from_parts", reports.trend_daily, _parts, ["avg_pm25"])
_report("extreme_from_parts", reports.extreme_summary, _parts)
_report("extreme_top_from_parts", reports.extreme_top, _parts)
_report("weekday_from_parts", reports.weekday_weekend, _parts, ["mean"])
_report("weekday_selected_from_parts", reports.weekday_weekend, _selected_parts, ["mean"])
_report("map_from_parts", reports.map_sites, _parts, ["avg_pm25", "radius"])


@query("filter_all")
def _filter_everything(spark, sf_dir) -> DataFrame:
    rows = filter_all(views.pm25(spark, sf_dir), views.places(spark, sf_dir), SELECTION)
    return rows.select(*_PLACED, "location_name", "date")


@query("sensor_metadata")
def _sensor_metadata_report(spark, sf_dir) -> DataFrame:
    shift = F.col("arrival") % 4 / 4
    facts = views.measurements(spark, sf_dir).withColumns(
        {
            "latitude": F.col("sensor_id") % 25 + shift,
            "longitude": -(F.col("sensor_id") % 50) - shift,
        }
    )
    return _six(sensor_metadata(facts, views.places(spark, sf_dir)), "latitude", "longitude")


@query("latest_per_sensor")
def _latest_per_sensor(spark, sf_dir) -> DataFrame:
    return merge.latest_per_sensor(views.measurements(spark, sf_dir))


@query("daily_summary")
def _daily_summary(spark, sf_dir) -> DataFrame:
    return _six(daily_summary(views.measurements(spark, sf_dir)), "value")


@query("aqi_category")
def _aqi_category(spark, sf_dir) -> DataFrame:
    value = F.col("value")
    return views.measurements(spark, sf_dir).select(
        "arrival",
        categories.short_label(value).alias("short_label"),
        categories.long_label(value).alias("long_label"),
        F.array_join(categories.colour(value), ",").alias("colour"),
        categories.severity(F.bround(value, 1)).alias("severity"),
    )


@query("parse_dates")
def _parse_dates(spark, sf_dir) -> DataFrame:
    date, form = F.col("o_orderdate"), F.col("o_orderkey") % 8
    text = (
        F.when(form == 0, F.date_format(date, "M/d/yyyy"))
        .when(form == 1, F.date_format(date, "MM/dd/yyyy"))
        .when(form == 2, F.date_format(date, "yyyy-M-d"))
        .when(form == 3, F.date_format(date, "yyyy/MM/dd"))
        .when(form == 4, F.date_format(date, "MMMM d, yyyy"))
        .when(form == 5, F.date_format(date, "MMM d yyyy"))
        .when(form == 6, F.date_format(date, "yyyy-MM-dd'T'06:30:00+02:00"))
        .otherwise(F.col("o_orderpriority"))
    )
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", to_iso_text(text).alias("parsed")
    )


# Dedup, merge, upsert


def _stored_and_batch(spark, sf_dir):
    rows = with_date(views.measurements(spark, sf_dir))
    early = rows.where("datetime_utc < timestamp_ntz'2024-01-16'")
    late = rows.where("datetime_utc >= timestamp_ntz'2024-01-10'")
    return dedup_first(early, views.ORDER, DAILY_KEY), late


@query("dedup_first")
def _dedup_first_daily(spark, sf_dir) -> DataFrame:
    rows = with_date(views.measurements(spark, sf_dir))
    return dedup_first(rows, views.ORDER, DAILY_KEY)


@query("insert_ignore")
def _insert_ignore(spark, sf_dir) -> DataFrame:
    stored, batch = _stored_and_batch(spark, sf_dir)
    return merge.insert_ignore(stored, batch, views.ORDER, DAILY_KEY)


@query("ingest_stats")
def _ingest_stats(spark, sf_dir) -> DataFrame:
    stored, batch = _stored_and_batch(spark, sf_dir)
    return merge.ingest_stats(stored, batch, DAILY_KEY)


def _stored_metadata(spark, sf_dir) -> DataFrame:
    key = F.col("s_suppkey")
    return views.table(spark, sf_dir, "supplier").select(
        key.alias("sensor_id"),
        F.col("s_name").alias("sensor_name"),
        F.lit("pm25").alias("parameter"),
        F.when(key % 3 != 0, key % 40 + 0.5).alias("latitude"),
        F.when(key % 3 != 0, -key % 90 - 0.5).alias("longitude"),
        F.lit("East").alias("region"),
        F.lit(dt.datetime(2023, 12, 1)).cast("timestamp_ntz").alias("last_seen"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp").alias("updated_at"),
    )


@query("metadata_upsert")
def _metadata_upsert(spark, sf_dir) -> DataFrame:
    """Measured sensors as the batch: the last row by arrival, filled per column."""
    even = F.col("arrival") % 2 == 0
    batch = views.measurements(spark, sf_dir).select(
        "sensor_id",
        F.concat(F.lit("sensor "), F.col("sensor_id").cast("string")).alias("sensor_name"),
        "parameter",
        F.when(even, F.col("arrival") % 40 + 0.25).alias("latitude"),
        F.when(even, -F.col("arrival") % 90 - 0.25).alias("longitude"),
        F.lit("Unknown").alias("region"),
        F.when(F.col("arrival") % 5 == 0, F.col("datetime_utc")).alias("last_seen"),
        "arrival",
    )
    stored = _stored_metadata(spark, sf_dir)
    merged = merge.upsert_metadata(stored, batch, AS_OF, arrival="arrival")
    return merged.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query("signal_upsert")
def _signal_upsert(spark, sf_dir) -> DataFrame:
    """Suppliers hold marks ahead of or behind the measured ones."""
    stored = views.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("sensor_id"),
        F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz").alias("last_data_datetime_utc"),
        F.lit(dt.datetime(2024, 1, 21)).cast("timestamp").alias("last_run_time"),
    )
    latest = merge.latest_per_sensor(views.pm25(spark, sf_dir))
    merged = merge.upsert_signal(stored, latest, AS_OF)
    return merged.withColumn("last_run_time", F.col("last_run_time").cast("timestamp_ntz"))


@query("signal_windows")
def _signal_windows(spark, sf_dir) -> DataFrame:
    signal = merge.latest_per_sensor(views.pm25(spark, sf_dir))
    return merge.signal_windows(signal, views.sensor_map(spark, sf_dir), dt.datetime(2024, 1, 1))


@query("sensor_metadata_record")
def _sensor_metadata_record(spark, sf_dir) -> DataFrame:
    landing = work_dir(spark, "sensors")
    views.land_sensors(spark, sf_dir, landing)
    overrides = region_overrides(spark, OVERRIDES)
    return ingest.sensor_metadata_records(read_sensor_pages(spark, landing), overrides)


@query("union_batches")
def _union_batches(spark, sf_dir) -> DataFrame:
    """The table in two parts by time, so that each scan skips the other part."""
    rows = views.measurements(spark, sf_dir).select(*ROW)
    split = F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")
    early, late = F.col("datetime_utc") < split, F.col("datetime_utc") >= split
    return ingest.union_batches([rows.where(early), rows.where(late)])


@query("run_summary")
def _run_summary(spark, sf_dir) -> DataFrame:
    requested = views.raw_coords(spark, sf_dir).select("location_id")
    return ingest.run_summary(requested, views.sensor_map(spark, sf_dir), views.pm25(spark, sf_dir))


# Whole ingest jobs


def _land_all(spark, sf_dir, base):
    events = views.table(spark, sf_dir, "events")
    views.land_locations(spark, sf_dir, f"{base}/locations")
    views.land_pages(events.where("ts < timestamp_ntz'2024-01-16'"), f"{base}/first")
    views.land_pages(events.where("ts >= timestamp_ntz'2024-01-10'"), f"{base}/second")


@query("ingest_batch")
def _ingest_batch(spark, sf_dir) -> DataFrame:
    """Two scheduled runs whose landed days overlap."""
    base = work_dir(spark, "scheduled")
    _land_all(spark, sf_dir, base)
    facts = FactTable(spark, f"{base}/facts")
    for batch in ("first", "second"):
        ingest.scheduled_run(
            spark,
            f"{base}/{batch}",
            read_location_pages(spark, f"{base}/locations"),
            views.raw_coords(spark, sf_dir).select("location_id"),
            views.coords(spark, sf_dir),
            facts,
            batch,
            f"{base}/stage",
            as_of=AS_OF,
        )
    return facts.read().select(*FACT.names)


def _backfilled(spark, sf_dir) -> tuple[DataFrame, FactTable]:
    """A backfill over a date range on top of a first one: its summary, and the table."""
    base = work_dir(spark, "backfill")
    _land_all(spark, sf_dir, base)
    facts = FactTable(spark, f"{base}/facts")
    for batch in ("first", "second"):
        summary = ingest.backfill_run(
            spark,
            f"{base}/{batch}",
            read_location_pages(spark, f"{base}/locations"),
            location_list(spark, ",".join(str(i) for i in range(30))),
            views.coords(spark, sf_dir),
            facts,
            batch,
            f"{base}/stage",
            "1/5/2024",
            "January 20, 2024",
            as_of=AS_OF,
        )
    return summary, facts


@query("ingest_backfill")
def _ingest_backfill(spark, sf_dir) -> DataFrame:
    return _backfilled(spark, sf_dir)[0]


@query("backfill_facts")
def _backfill_facts(spark, sf_dir) -> DataFrame:
    return _backfilled(spark, sf_dir)[1].read().select(*FACT.names)


# Streams


@query("stream_ingest")
def _stream_ingest(spark, sf_dir) -> DataFrame:
    """Two streams with landings and checkpoints of their own feed one table."""
    base = work_dir(spark, "stream")
    events = views.table(spark, sf_dir, "events")
    facts = FactTable(spark, f"{base}/facts")
    parts = {"early": "ts < timestamp_ntz'2024-01-16'", "late": "ts >= timestamp_ntz'2024-01-10'"}
    for source, part in parts.items():
        views.land_pages(events.where(part), f"{base}/landing-{source}")
        pages = read_page_stream(spark, f"{base}/landing-{source}")
        checkpoint = f"{base}/checkpoint-{source}"
        jobs.start_ingest(
            spark, pages, facts, f"{base}/stage", checkpoint, source, as_of=AS_OF
        ).awaitTermination()
    return facts.read().select(*FACT.names)


@query("stream_dedup")
def _stream_dedup(spark, sf_dir) -> DataFrame:
    """Every row sent twice."""
    base = work_dir(spark, "dedup")
    rows = views.event_stream(spark, sf_dir)
    once = jobs.dedup_stream(rows.unionByName(views.event_stream(spark, sf_dir)))
    jobs.start_to_parquet(
        once.select(*ROW), f"{base}/out", f"{base}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("stream_first")
def _stream_first(spark, sf_dir) -> DataFrame:
    """Every row sent again with another value, the odd ones as having arrived before."""
    base = work_dir(spark, "first")
    odd = F.col("arrival") % 2 == 1
    rows = views.event_stream(spark, sf_dir).select(*ROW)
    again = views.event_stream(spark, sf_dir).select(*ROW).withColumns(
        {"arrival": F.col("arrival") + F.when(odd, -1_000_000_000).otherwise(1_000_000_000), "value": F.col("value") + 1}
    )
    beats = f"{base}/beats"
    jobs.heartbeat(spark, dt.datetime(2000, 1, 1), rows.schema).write.parquet(beats)
    sent = rows.unionByName(again).unionByName(spark.readStream.schema(rows.schema).parquet(beats))
    for _ in range(2):
        first = jobs.first_stream(sent, ["arrival"])
        jobs.start_to_parquet(first, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        # All rows are in: time moves on, and what is still open is settled.
        jobs.heartbeat(spark, dt.datetime(2100, 1, 1), rows.schema).write.mode("append").parquet(beats)
    return spark.read.schema(rows.schema).parquet(f"{base}/out")


@query("stream_signal")
def _stream_signal(spark, sf_dir) -> DataFrame:
    base = work_dir(spark, "signal")
    signal = SnapshotTable(spark, f"{base}/signal", SIGNAL)
    rows = views.event_stream(spark, sf_dir)
    jobs.start_signal(rows, signal, f"{base}/checkpoint", AS_OF).awaitTermination()
    return signal.read().select("sensor_id", "last_data_datetime_utc")


@query("stream_alerts")
def _stream_alerts(spark, sf_dir) -> DataFrame:
    base = work_dir(spark, "alerts")
    rows = jobs.alerts(views.event_stream(spark, sf_dir)).select(*ROW)
    jobs.start_to_parquet(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("stream_daily")
def _stream_daily(spark, sf_dir) -> DataFrame:
    """All days of the table, as the stream has them in the end: what the batch job gives."""
    base = work_dir(spark, "daily")
    rows = views.event_stream(spark, sf_dir)
    jobs.start_daily(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _six(jobs.read_daily(spark, f"{base}/out"), "value")
