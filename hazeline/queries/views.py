"""The given tables seen as measurements, lookups and landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.functions.text import is_pm25
from hazeline.operators.places import Directory

ORDER = ["arrival"]
DAILY_KEY = ["sensor_id", "parameter", "date"]
PAGE_RESULTS = 1000
LOCATION_SENSORS = 100


# The columns queries use; a declared schema saves a job per read.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
        " value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def parameter_of(event_type: Column) -> Column:
    return (
        F.when(event_type == "click", "pm25")
        .when(event_type == "signup", "PM25")
        .when(event_type == "view", "PM2.5")
        .when(event_type == "error", "pm_10")
        .otherwise("o3")
    )


def as_measurements(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("sensor_id"),
        parameter_of(F.col("event_type")).alias("parameter"),
        F.col("ts").alias("datetime_utc"),
        F.when(F.col("event_id") % 41 != 0, F.col("value")).alias("value"),
        F.col("event_id").alias("arrival"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_measurements(table(spark, sf_dir, "events"))


def pm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measurements(spark, sf_dir).where(is_pm25(F.col("parameter")))


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.to_date("datetime_utc"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements over all months of several years."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("sensor_id"),
        F.col("l_shipdate").alias("datetime_utc"),
        F.col("l_quantity").alias("value"),
    )


def sensor_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_custkey % 7 <> 0")
        .select(
            F.col("c_custkey").alias("sensor_id"),
            F.col("c_nationkey").cast("long").alias("location_id"),
        )
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where("n_nationkey % 11 <> 10")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("location_id"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("city"),
    )


def raw_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    known = key % 9 != 8
    return table(spark, sf_dir, "nation").select(
        key.cast("long").alias("location_id"),
        F.when(known, 25.0 + key).alias("latitude"),
        F.when(known, -120.0 + 2.5 * key).alias("longitude"),
    )


def coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_coords(spark, sf_dir).dropna()


def places(spark: SparkSession, sf_dir: str) -> Directory:
    return Directory(
        sensor_map(spark, sf_dir), locations(spark, sf_dir), coords(spark, sf_dir)
    )


def land_locations(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Location pages in two listings: customers are sensors at their nation.

    Every fifth sensor measures something else, every seventh has no
    coordinates. A page lists at most LOCATION_SENSORS sensors. The first listing
    leaves out a third of them and has the others at the next nation, with other
    coordinates; the second leaves out another third. Ids are text, and the second
    listing has a broken line.
    """
    key = F.col("c_custkey")
    other = F.struct((key % 7 + 10.5).alias("latitude"), (-key % 9 - 0.5).alias("longitude"))
    own = F.struct((key % 50 + 0.5).alias("latitude"), (-key % 100 - 0.25).alias("longitude"))
    customers = table(spark, sf_dir, "customer")
    home = F.col("c_nationkey")
    _land_listing(customers.where("c_custkey % 3 <> 1"), (home + 1) % 25, other, f"{path}/listing=1")
    _land_listing(customers.where("c_custkey % 3 <> 0"), home, own, f"{path}/listing=2")
    land_broken(spark, f"{path}/listing=2")


def land_broken(spark: SparkSession, path: str) -> None:
    """One more file, with half a line of JSON."""
    spark.range(1).select(F.lit('{"id": 1, "sens')).coalesce(1).write.mode("append").text(path)


def _land_listing(customers: DataFrame, location: Column, spot: Column, path: str) -> None:
    key = F.col("c_custkey")
    name = F.when(key % 5 == 0, "o3").when(key % 5 == 1, "PM25").otherwise("pm25")
    sensor = F.struct(
        key.alias("id"),
        F.concat(F.lit("sensor "), key.cast("string")).alias("name"),
        F.struct(name.alias("name")).alias("parameter"),
        F.when(key % 7 != 0, spot).alias("coordinates"),
    )
    page = F.floor(key / LOCATION_SENSORS)
    (
        customers.groupBy(location.cast("string").alias("id"), page.alias("page"))
        .agg(F.collect_list(sensor).alias("sensors"))
        .drop("page")
        .write.json(path)
    )


def landed_results(events: DataFrame) -> DataFrame:
    """Events as page results, dated by the day they fall on.

    Values are text with some ``n/a``, as they come from outside; some results
    lack coverage, summary or coordinates.
    """
    n = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    value = F.when(n % 41 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    low, high = ((F.col("value") * f).cast("string") for f in (0.5, 2.0))
    result = F.struct(
        value.alias("value"),
        F.struct(parameter_of(F.col("event_type")).alias("name"), F.lit("µg/m³").alias("units"))
        .alias("parameter"),
        F.struct(
            F.struct(
                F.concat(day, F.lit("T00:00:00Z")).alias("utc"),
                F.concat(day, F.lit("T00:00:00-05:00")).alias("local"),
            ).alias("datetime_from")
        ).alias("period"),
        F.when(n % 3 != 0, F.struct((n % 100).cast("string").alias("percent_complete")))
        .alias("coverage"),
        F.when(
            n % 4 != 0,
            F.struct(
                low.alias("min"), high.alias("max"), F.col("value").cast("string").alias("median")
            ),
        ).alias("summary"),
        F.when(
            n % 2 == 0,
            F.struct(F.lit("10.5").alias("latitude"), F.lit("-20.5").alias("longitude")),
        ).alias("coordinates"),
    )
    return events.select(
        "run", "event_id", F.col("user_id").alias("sensor_id"), day.alias("day"), result.alias("result")
    )


def land_pages(events: DataFrame, path: str) -> None:
    """Measurement pages, days as folders, in the order of the events.

    A page holds results of one sensor and day out of one run of PAGE_RESULTS
    events, so that no page grows with the data. Runs are spread over tasks in
    their order, and each lies in one task, which makes it the only shuffle.
    """
    run = F.floor(F.col("event_id") / PAGE_RESULTS)
    spread = events.withColumn("run", run).repartitionByRange("run")
    pages = landed_results(spread).groupBy("day", "run", "sensor_id")
    listed = F.sort_array(F.collect_list(F.struct("event_id", "result")))
    pages = pages.agg(F.transform(listed, lambda r: r.result).alias("results"))
    (
        pages.sortWithinPartitions("day", "run", "sensor_id")
        .select("day", "sensor_id", F.lit("17").alias("location_id"), "results")
        .write.partitionBy("day")
        .json(path)
    )


def land_sensors(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Sensor records: customers, some without position, parameter or last time."""
    key = F.col("c_custkey")
    spot = F.struct((key % 60 + 0.5).alias("latitude"), (-key % 130 - 0.25).alias("longitude"))
    day = F.lpad((key % 28 + 1).cast("string"), 2, "0")
    last = F.concat(F.lit("2024-01-"), day, F.lit("T06:00:00Z"))
    table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.col("c_name").alias("name"),
        F.when(key % 6 != 0, F.struct(F.lit("pm25").alias("name"))).alias("parameter"),
        F.when(key % 7 != 0, F.struct(spot.alias("coordinates"))).alias("latest"),
        F.when(key % 4 != 0, F.struct(last.alias("utc"))).alias("datetime_last"),
    ).write.json(path)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files.

    The path is a pattern, so that the table may be a file or a folder.
    """
    schema = table(spark, sf_dir, "events").schema
    return as_measurements(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet"))


def _land_csv(rows: DataFrame, path: str, listing: int) -> None:
    rows.write.option("header", True).csv(f"{path}/listing={listing}")


def land_location_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``State,Code,City`` in two listings: customers as locations.

    Some codes are no numbers, some are written as decimals, some cities are
    missing, and the second listing names a third of the first one's anew.
    """
    key, rows = F.col("c_custkey"), table(spark, sf_dir, "customer")
    state = F.concat(F.lit("State "), F.col("c_nationkey").cast("string")).alias("State")
    code = F.when(key % 11 == 0, "n/a").when(key % 4 == 0, F.concat(key.cast("string"), F.lit(".0")))
    code = F.coalesce(code, key.cast("string")).alias("Code")
    city = F.when(key % 13 != 0, F.col("c_name")).alias("City")
    _land_csv(rows.where("c_custkey % 3 <> 1").select(state, code, F.lit("Old").alias("City")), path, 1)
    _land_csv(rows.where("c_custkey % 3 <> 0").select(state, code, city), path, 2)


def land_map_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``sensor_id,location_id`` in two listings, some ids bad or missing."""
    key, home = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    rows = table(spark, sf_dir, "customer")
    sensor = F.when(key % 11 == 0, "none").otherwise(key.cast("string")).alias("sensor_id")
    location = F.when(key % 13 != 0, home).alias("location_id")
    _land_csv(rows.where("c_custkey % 3 <> 1").select(sensor, F.lit("99").alias("location_id")), path, 1)
    _land_csv(rows.where("c_custkey % 3 <> 0").select(sensor, location), path, 2)


def land_coords_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``location_id,latitude,longitude`` and one more column, in two listings, some parts bad."""
    key, rows = F.col("c_custkey"), table(spark, sf_dir, "customer")
    north = F.when(key % 7 == 0, "nan").otherwise((key % 50 + 0.5).cast("string")).alias("latitude")
    west = F.when(key % 5 != 0, (-key % 90 - 0.25).cast("string")).alias("longitude")
    zero = [F.lit("0.5").alias("latitude"), F.lit("0.25").alias("longitude")]
    more = F.lit("x").alias("note")
    _land_csv(rows.where("c_custkey % 3 <> 1").select(key.alias("location_id"), *zero, more), path, 1)
    _land_csv(rows.where("c_custkey % 3 <> 0").select(key.alias("location_id"), north, west, more), path, 2)
