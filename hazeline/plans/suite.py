"""The whole set of reports over one selection, written as small tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators.partials import HIGH, LOW, ROWS, TOTAL, VALUES, measures
from hazeline.operators.places import Directory, fill_names
from hazeline.plans import reports
from hazeline.plans.loading import filter_all
from hazeline.plans.reports import CUBE_KEYS, DERIVED, EXTREME_FROM, Parts, Scope

JOBS_AT_A_TIME = 4

REPORTS = {
    "kpis": reports.kpis,
    "kpi_display": reports.kpi_display,
    "map_sites": reports.map_sites,
    "map_display": reports.map_display,
    "map_center": reports.map_center,
    "coord_coverage": reports.coord_coverage,
    "extreme_summary": reports.extreme_summary,
    "extreme_top": reports.extreme_top,
    "top_locations": reports.top_locations,
    "trend_daily": reports.trend_daily,
    "aqi_distribution": reports.aqi_distribution,
    "aqi_rollup": reports.aqi_rollup,
    "weekday_weekend": reports.weekday_weekend,
    "weekday_diff": reports.weekday_diff,
    "seasonal": reports.seasonal,
    "season_extremes": reports.season_extremes,
}


def with_cube(spark: SparkSession, scope: Scope, path: str) -> Scope:
    """Write the cube of a scope as a table and let its reports use it.

    A written table outlives lost executors, and the rows are scanned once for
    all reports that merge from it.
    """
    scope.build_cube().write.mode("overwrite").parquet(path)
    return replace(scope, cube=spark.read.parquet(path))


SPOT = ["location_id", "latitude", "longitude"]
_EVENT = ["sensor_id", "datetime_utc", "value"]
_SETS = {
    "cube": [*SPOT, *CUBE_KEYS],
    "days": ["location_id", "date"],
    "bins": ["day_type", "bin"],
    "events": [*SPOT, "event"],
}


def build_parts(scope: Scope) -> DataFrame:
    """Everything the reports need, from one reading of the selected rows.

    Rows meet the places once and are summed by four sets of keys at a time, in the
    reading tasks before anything moves; ``part`` names the set. Single rows are keys
    only where they are extreme events. Names of places are left out, as they follow
    from the location; ``with_parts`` adds them where rows are few.
    """
    placed = filter_all(scope.df, scope.where, scope.selection)
    spot = [c for c in SPOT if c in placed.columns]
    rows = placed.withColumns({k: DERIVED[k]() for k in ("bin", *CUBE_KEYS)})
    extreme = F.col("value") >= EXTREME_FROM
    rows = rows.withColumn("event", F.when(extreme, F.struct(*_EVENT)))
    sets = {name: [k for k in keys if k not in SPOT or k in spot] for name, keys in _SETS.items()}
    keys = sorted({k for held in sets.values() for k in held})
    grouped = rows.select(*keys, "value").groupingSets([[F.col(k) for k in held] for held in sets.values()], *keys)
    part = F.when(F.grouping("event") == 0, "events").when(F.grouping("bin") == 0, "bins")
    part = part.when(F.grouping("date") == 0, "days").otherwise("cube")
    return grouped.agg(*measures(), part.alias("part"))


def _named(df: DataFrame, where: Directory) -> DataFrame:
    """Partials by location with its names, which hang on the location alone."""
    names = where.locations.select("location_id", "state", "city")
    met = df.join(names, "location_id", "left").withColumns(
        {"sensor_id": F.col("location_id"), "is_fallback": F.lit(False)}
    )
    return fill_names(met).drop("sensor_id", "is_fallback")


def with_parts(spark: SparkSession, scope: Scope, path: str) -> Scope:
    """Write what the reports need as one table, and let them use it.

    Measurements are read once; only a median between two values of one narrow range
    reads the rows of that range again.
    """
    built = build_parts(scope)
    built.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(path)
    table = spark.read.schema(built.schema).parquet(path)

    def part(name: str) -> DataFrame:
        kept = [c for c in _SETS[name] if c in table.columns]
        return table.where(F.col("part") == name).select(*kept, ROWS, VALUES, TOTAL, LOW, HIGH)

    # Rows below the threshold of an event share one empty key.
    events = _named(part("events").where("event is not null"), scope.where)
    events = events.select("*", *[F.col(f"event.{c}").alias(c) for c in _EVENT]).drop("event")
    parts = Parts(_named(part("cube"), scope.where), _named(part("days"), scope.where), part("bins"), events)
    return replace(scope, cube=parts.cube, parts=parts)


def run_suite(
    spark: SparkSession,
    scope: Scope,
    out: str,
    names: Sequence[str] = tuple(REPORTS),
    selected_cities: Sequence[str] = (),
    trend_cities: int | None = reports.TREND_CITIES,
) -> dict[str, DataFrame]:
    """Write each report below ``out`` and return the written tables.

    Measurements are read once, for the partials that all of them start from.
    """
    scoped = with_parts(spark, scope, f"{out}/cube")

    def write(name: str) -> None:
        report = REPORTS[name]
        if name == "trend_daily":
            frame = report(scoped, selected_cities or scope.selection.cities, trend_cities)
        else:
            frame = report(scoped)
        frame.write.mode("overwrite").parquet(f"{out}/{name}")

    # The reports are small by now; a few jobs at a time fill the cluster.
    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        list(pool.map(write, names))
    return {name: spark.read.parquet(f"{out}/{name}") for name in names}
