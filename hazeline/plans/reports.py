"""The reports, each one plan from measurement rows to a small table.

``df`` holds measurements (sensor_id, datetime_utc, value and, if stored with
the rows, latitude and longitude). Filters on rows run first, then rows shrink
to partial aggregates by sensor, and only those meet the directory. Rows
themselves are joined to places only where a report needs single rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazeline.functions import categories
from hazeline.functions.dates import day_type, month_name
from hazeline.functions.numbers import display, display_int, half_even, tooltip
from hazeline.operators.filters import filter_threshold
from hazeline.operators.median import exact_median
from hazeline.operators.partials import HIGH, LOW, ROWS, TOTAL, VALUES, mean, partials
from hazeline.operators.places import Directory, attach_to_sensors
from hazeline.plans.loading import Selection, filter_all, select_at_scan, select_places, select_rows

# From where a reading is an extreme event, and how many cities
# the trend shows unless told otherwise.
EXTREME_FROM = 150
TREND_CITIES = 5
SITE = ["location_id", "location_name", "latitude", "longitude"]


# Ranges of values for counts that bracket a median: about 4096 to each factor of e, some six
# million between all doubles, however many rows there are. log1p never falls as values rise.
BINS_A_FACTOR = 4096

# Columns reports group by, made from a measurement row.
DERIVED = {
    "calendar_month": lambda: F.month("datetime_utc"),
    "day_type": lambda: day_type(F.to_date("datetime_utc")),
    "category": lambda: categories.long_label(F.col("value")),
    "bin": lambda: (F.signum("value") * F.floor(F.log1p(F.abs("value")) * BINS_A_FACTOR)).cast("int"),
}
CUBE_KEYS = ["calendar_month", "day_type", "category"]


PLACE = ["location_id", "location_name", "state", "city", "latitude", "longitude"]


@dataclass(frozen=True)
class Parts:
    """What one reading of the measurements leaves for every report; see ``plans.suite``.

    Each holds partials: ``cube`` by place and CUBE_KEYS, ``days`` by place and date,
    ``bins`` by day type and range of values, ``events`` by single extreme row.
    """

    cube: DataFrame
    days: DataFrame
    bins: DataFrame
    events: DataFrame


def _derived(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: DERIVED[k]() for k in keys})


@dataclass(frozen=True)
class Scope:
    """Measurements, the directory of places, and what to report on.

    ``cube`` are partials of everything selected by place and ``CUBE_KEYS``. If
    it is there, reports that can be merged from it read neither rows nor
    lookups again. With ``parts`` none does.
    """

    df: DataFrame
    where: Directory
    selection: Selection = field(default_factory=Selection)
    cube: DataFrame | None = None
    parts: Parts | None = None

    def rows(self, *keys: str) -> DataFrame:
        """Selected rows, by the filters rows can answer, with derived keys."""
        return _derived(select_rows(self.df, self.selection), keys)

    def _in_cube(self, keys) -> bool:
        return self.cube is not None and set(keys) <= set(self.cube.columns)

    def by_place(self, *keys: str) -> DataFrame:
        """Partials by keys and place, or finer, inside the selection.

        From rows they are by sensor: places are joined after rows have shrunk.
        """
        if self._in_cube(keys):
            return self.cube
        rows = _derived(select_at_scan(self.df, self.where, self.selection), keys)
        stored = [c for c in ("latitude", "longitude") if c in rows.columns]
        placed = attach_to_sensors(partials(rows, "sensor_id", *stored, *keys), self.where)
        return select_places(placed, self.selection)

    def by(self, *keys: str) -> DataFrame:
        """Partials by keys that need no place, places joined only to select."""
        if self.selection.by_place or self._in_cube(keys):
            return partials(self.by_place(*keys), *keys)
        return partials(self.rows(*keys), *keys)

    def build_cube(self) -> DataFrame:
        """At most 2 x 12 x 6 rows per place, however much was measured."""
        placed = self.by_place(*CUBE_KEYS)
        return partials(placed, *[c for c in PLACE if c in placed.columns], *CUBE_KEYS)


def kpis(scope: Scope) -> DataFrame:
    """One row: locations, mean, peak and number of rows, also as text."""
    sites = partials(scope.by_place(), "location_id")
    overall = sites.agg(
        F.count("location_id").alias("locations"),
        F.sum(ROWS).alias(ROWS),
        F.sum(VALUES).alias(VALUES),
        F.sum(TOTAL).alias(TOTAL),
        F.max(HIGH).alias("peak_pm25"),
    )
    return overall.select(
        "locations",
        mean().alias("avg_pm25"),
        "peak_pm25",
        F.coalesce(F.col(ROWS), F.lit(0)).alias("rows"),
    )


def kpi_display(scope: Scope) -> DataFrame:
    return kpis(scope).select(
        display_int(F.col("locations")).alias("locations"),
        display(F.col("avg_pm25")).alias("avg_pm25"),
        display(F.col("peak_pm25")).alias("peak_pm25"),
        display_int(F.col("rows")).alias("rows"),
    )


def _sites(scope: Scope) -> DataFrame:
    sites = partials(scope.by_place(), *SITE)
    return sites.select(
        *SITE,
        mean().alias("avg_pm25"),
        F.col(HIGH).alias("max_pm25"),
        F.col(VALUES).alias("measurements"),
        F.col(ROWS),
    )


def _with_coords(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def map_sites(scope: Scope) -> DataFrame:
    """Sites with coordinates, the dirtiest first, with their dot radius."""
    average = F.col("avg_pm25")
    radius = F.when(average.isNotNull(), F.greatest(average, F.lit(5.0)) * 2000)
    sites = _with_coords(_sites(scope)).drop(ROWS).withColumn("radius", radius)
    return sites.orderBy(average.desc_nulls_last(), "location_id", "latitude", "longitude")


def map_display(scope: Scope) -> DataFrame:
    """Tooltip text and dot colour of each site on the map."""
    return map_sites(scope).select(
        "location_id",
        "location_name",
        "latitude",
        "longitude",
        tooltip(F.col("avg_pm25")).alias("avg_pm25_display"),
        tooltip(F.col("max_pm25")).alias("max_pm25_display"),
        categories.colour(F.col("avg_pm25")).alias("colour"),
    )


def map_center(scope: Scope) -> DataFrame:
    """Mean position over sites, each site counted once."""
    sites = _with_coords(_sites(scope))
    return sites.agg(
        F.avg("latitude").alias("latitude"),
        F.avg("longitude").alias("longitude"),
    )


def coord_coverage(scope: Scope) -> DataFrame:
    """Rows and groups, all of them and those that have coordinates."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return _sites(scope).agg(
        F.coalesce(F.sum(ROWS), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(located, F.col(ROWS))), F.lit(0)).alias("rows_with_coords"),
        F.count(F.lit(1)).alias("groups"),
        F.count_if(located).alias("groups_with_coords"),
    )


def top_locations(scope: Scope, top_n: int = 10) -> DataFrame:
    """Ranking by mean. The category follows the mean before it is rounded."""
    average = F.col("avg_pm25")
    order = [average.desc_nulls_last(), "location_id", "latitude", "longitude"]
    top = _with_coords(_sites(scope)).orderBy(*order).limit(top_n)
    # The window sees top_n rows.
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.select(
        "rank",
        "location_id",
        "location_name",
        half_even(average).alias("avg_pm25"),
        half_even(F.col("max_pm25")).alias("max_pm25"),
        categories.short_label(average).alias("category"),
        "measurements",
    )


def _top_cities(placed: DataFrame, cities: int | None) -> DataFrame:
    ranked = partials(placed, "city").select("city", mean().alias("avg_pm25"))
    ranked = ranked.orderBy(F.col("avg_pm25").desc_nulls_last(), "city")
    return ranked if cities is None else ranked.limit(cities)


def trend_cities(scope: Scope, cities: int | None = TREND_CITIES) -> DataFrame:
    """The cities the trend shows if none is selected, the most polluted first."""
    return _top_cities(scope.by_place(), cities)


def trend_daily(
    scope: Scope, selected: Sequence[str] = (), cities: int | None = TREND_CITIES
) -> DataFrame:
    """Daily means by location name.

    ``cities`` is how many cities are shown: the first of the selected ones, or
    without a selection the most polluted. None shows all. A city name found in
    two states gives two lines.
    """
    # A sensor has about one row a day, so rows do not shrink by sensor and day.
    # They meet the lookups first, and shrink to the days of a city's sites.
    placed = scope.parts.days if scope.parts else filter_all(scope.df, scope.where, scope.selection)
    daily = partials(placed, "city", "location_name", "date")
    if selected:
        shown = daily.where(F.col("city").isin(list(selected)[:cities]))
    elif cities is None:
        shown = daily
    else:
        # Ranked from the same daily partials, so rows are read once; a semi
        # join would sink below them. ``cities`` rows at most, all different.
        shown = daily.join(F.broadcast(_top_cities(daily, cities).select("city")), "city")
    lines = partials(shown, "date", "location_name")
    return lines.select("date", "location_name", mean().alias("avg_pm25"))


def aqi_distribution(scope: Scope) -> DataFrame:
    """Rows by category and their share of all rows, missing values included."""
    counts = scope.by("category")
    # The window sees one row per category.
    share = F.col(ROWS) / F.sum(ROWS).over(Window.partitionBy()) * 100
    return counts.select(
        "category", F.col(ROWS).alias("n"), half_even(share).alias("percentage")
    )


def aqi_rollup(scope: Scope) -> DataFrame:
    """Good, moderate and unhealthy share; the last sums rounded parts."""
    good, moderate, *unhealthy = categories.LONG_LABELS
    table = aqi_distribution(scope)

    def total(*labels):
        part = F.sum(F.when(F.col("category").isin(*labels), F.col("percentage")))
        return F.round(F.coalesce(part, F.lit(0.0)), 1)

    return table.agg(
        total(good).alias("good_pct"),
        total(moderate).alias("moderate_pct"),
        total(*unhealthy).alias("unhealthy_pct"),
    )


def extreme_summary(scope: Scope, threshold: float = EXTREME_FROM) -> DataFrame:
    """How many locations and days reached the threshold, and the peak."""
    if scope.parts:
        # A location's day reached the threshold if its highest value did.
        events = scope.parts.days.where(F.col(HIGH) >= threshold)
    else:
        extreme = filter_threshold(scope.df, threshold)
        placed = filter_all(extreme, scope.where, scope.selection)
        events = partials(placed, "location_id", "date")
    return events.agg(
        F.countDistinct("location_id").alias("num_locations"),
        F.countDistinct("date").alias("num_days"),
        F.max(HIGH).alias("max_value"),
    )


def extreme_top(scope: Scope, threshold: float = EXTREME_FROM, top_n: int = 10) -> DataFrame:
    """The highest single rows at or above the threshold.

    Each task keeps its top rows. Without a choice of places the rest of the
    rows never meets the directory.
    """
    order = [F.col("value").desc(), "datetime_utc", "sensor_id"]
    if scope.parts and threshold >= EXTREME_FROM:
        # Equal rows are one with a count: as many as are shown come out again.
        events = filter_threshold(scope.parts.events, threshold).orderBy(*order).limit(top_n)
        again = F.explode(F.sequence(F.lit(1), F.least(F.col(ROWS), F.lit(top_n)).cast("int")))
        top = events.withColumn("_copy", again).orderBy(*order).limit(top_n)
    elif scope.selection.by_place:
        rows = filter_all(filter_threshold(scope.df, threshold), scope.where, scope.selection)
        top = rows.orderBy(*order).limit(top_n)
    else:
        top = filter_threshold(scope.rows(), threshold).orderBy(*order).limit(top_n)
        top = attach_to_sensors(top, scope.where)
    value = half_even(F.col("value"))
    return top.orderBy(*order).select(
        categories.severity(value).alias("severity"),
        F.to_date("datetime_utc").alias("date"),
        "location_name",
        value.alias("value"),
        "latitude",
        "longitude",
    )


def _medians_from_parts(scope: Scope) -> DataFrame:
    """Exact median by day type.

    The counts by range of values tell which ranges hold the middle ranks. A range with
    one value only gives it at once; else the rows between its least and highest value are
    read, and no others.
    """
    bins = scope.parts.bins.where(F.col(VALUES) > 0)
    # A bounded number of rows by day type; see BINS_A_FACTOR.
    upto = Window.partitionBy("day_type").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bins.withColumn("upto", F.sum(VALUES).over(upto)).withColumn(
        "total", F.sum(VALUES).over(Window.partitionBy("day_type"))
    )
    ranks = F.array(F.expr("(total + 1) div 2"), F.expr("total div 2 + 1"))
    middle = ranked.select("*", F.posexplode(ranks).alias("which", "rank")).where(
        (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col(VALUES) < F.col("rank"))
    )
    rank = (F.col("rank") - F.col("upto") + F.col(VALUES)).alias("rank")
    # Two ranks of two day types.
    found = middle.select("day_type", "which", rank, LOW, HIGH).collect()
    wanted = scope.df.sparkSession.createDataFrame(
        found, f"day_type string, which int, rank long, {LOW} double, {HIGH} double"
    )
    settled = wanted.where(F.col(LOW) == F.col(HIGH)).select("day_type", F.col(LOW).alias("value"))
    spans = {(row["day_type"], row[LOW], row[HIGH]) for row in found if row[LOW] < row[HIGH]}
    if spans:
        inside = [F.col("value").between(low, high) for _, low, high in sorted(spans)]
        near = filter_all(scope.df.where(reduce(Column.__or__, inside)), scope.where, scope.selection)
        counted = near.withColumn("day_type", DERIVED["day_type"]()).groupBy("day_type", "value").agg(F.count(F.lit(1)).alias("n"))
        open_ = wanted.where(F.col(LOW) < F.col(HIGH))
        # Four rows at most.
        met = counted.join(F.broadcast(open_), "day_type").where(F.col("value").between(F.col(LOW), F.col(HIGH)))
        within = Window.partitionBy("day_type", "which").orderBy("value")
        within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = met.withColumn("upto", F.sum("n").over(within))
        settled = settled.unionByName(
            met.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))).select("day_type", "value")
        )
    return settled.groupBy("day_type").agg((F.sum("value") / 2).alias("median"))


def weekday_weekend(scope: Scope) -> DataFrame:
    """Mean, exact median, peak and count for weekdays and for weekends."""
    if scope.parts:
        figures = scope.by("day_type").select(
            "day_type", mean().alias("mean"), F.col(HIGH).alias("max"), F.col(VALUES).alias("count")
        )
        # Two rows on either side.
        joined = figures.join(F.broadcast(_medians_from_parts(scope)), "day_type", "left")
        return joined.select("day_type", "mean", "median", "max", "count")
    typed = scope.rows("day_type")
    if scope.selection.by_place:
        # The median needs single values, so the rows themselves are selected.
        rows = filter_all(scope.df, scope.where, scope.selection)
        typed = rows.withColumn("day_type", DERIVED["day_type"]())
    figures = typed.groupBy("day_type").agg(
        F.avg("value").alias("mean"), F.max("value").alias("max"), F.count("value").alias("count")
    )
    # Two rows on either side.
    joined = figures.join(F.broadcast(exact_median(typed, ["day_type"])), "day_type", "left")
    return joined.select("day_type", "mean", "median", "max", "count")


def weekday_diff(scope: Scope) -> DataFrame:
    """Weekday mean against weekend mean; no row unless both exist."""
    both = scope.by("day_type").withColumn("mean", mean())

    def of(kind):
        return F.max(F.when(F.col("day_type") == kind, F.col("mean")))

    pair = both.agg(
        of("Weekday").alias("weekday_mean"),
        of("Weekend").alias("weekend_mean"),
        F.count(F.lit(1)).alias("kinds"),
    ).where("kinds = 2")
    weekday, weekend = F.col("weekday_mean"), F.col("weekend_mean")
    diff = F.try_divide(weekday - weekend, weekend) * 100
    pair = pair.select("weekday_mean", "weekend_mean", diff.alias("diff_pct"))
    diff = F.col("diff_pct")
    verdict = (
        F.when(F.abs(diff) <= 5, F.lit("similar"))
        .when(diff > 5, F.lit("weekday higher"))
        .when(diff < -5, F.lit("weekend higher"))
    )
    return pair.withColumn("verdict", verdict)


def seasonal(scope: Scope) -> DataFrame:
    """Mean, least and highest value by calendar month, over all years."""
    return (
        scope.by("calendar_month")
        .select(
            F.col("calendar_month").alias("month"),
            month_name(F.make_date(F.lit(2000), "calendar_month", F.lit(1))).alias("month_name"),
            mean().alias("mean"),
            F.col(LOW).alias("min"),
            F.col(HIGH).alias("max"),
        )
        .orderBy("month")
    )


def season_extremes(scope: Scope) -> DataFrame:
    """Worst and best month by mean; of equals, the earlier one."""
    months = seasonal(scope).where("mean is not null")
    row = F.struct("month_name", "mean")
    worst = F.max_by(row, F.struct(F.col("mean"), -F.col("month")))
    best = F.min_by(row, F.struct(F.col("mean"), F.col("month")))
    return months.agg(worst.alias("w"), best.alias("b")).select(
        F.col("w.month_name").alias("worst_month"),
        F.col("w.mean").alias("worst_mean"),
        F.col("b.month_name").alias("best_month"),
        F.col("b.mean").alias("best_mean"),
    )
