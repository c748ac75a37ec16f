"""File exports: measurements by sensor, and the sensor map."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from functools import partial
from itertools import chain, groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.operators.pick import last_per_key
from hazeline.schemas import require
from hazeline.sources.dimensions import read_sensor_map
from hazeline.sources.files import clear_folder, last_version, local_path, mark_complete
from hazeline.sources.landing import ARRIVAL

# Most rows in one exported file; a larger sensor gets several.
ROWS_PER_FILE = 5_000_000

# The writer travels with its tasks, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def export_by_sensor(df: DataFrame, path: str) -> None:
    """CSV with header, one folder per sensor.

    The rebalance keeps a sensor in one file, but splits one that holds a
    large share of all rows over several tasks and files. On a mounted disk the
    tasks create the files themselves: Hadoop's local file system starts a process
    for each file, its checksum and its folder, which takes longer than the rows do.
    """
    dealt = df.hint("rebalance", F.col("sensor_id"))
    folder = local_path(df.sparkSession, path)
    # ``to_csv`` fails on a lone missing value.
    if folder is not None and len(df.columns) > 2:
        _export_to_disk(dealt, path, folder)
        return
    (
        dealt.write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("sensor_id")
        .csv(path)
    )


def _export_to_disk(dealt: DataFrame, path: str, folder: str) -> None:
    """The same folders and lines as Spark's writer, from one Python writer per task.

    Spark renders the lines. They are sorted, so that a task that runs again writes
    the same files; each gets its name when it is whole, and ``_SUCCESS`` comes last.
    """
    spark = dealt.sparkSession
    columns = [c for c in dealt.columns if c != "sensor_id"]
    names = F.to_csv(F.struct(*[F.lit(c).alias(c) for c in columns]))
    header = spark.range(1).select(names).first()[0]
    lines = dealt.select(F.col("sensor_id").cast("string"), F.to_csv(F.struct(*columns)).alias("line"))
    lines = lines.sortWithinPartitions("sensor_id", "line")
    clear_folder(spark, path)
    writer = partial(_write_files, folder=folder, header=header, most=ROWS_PER_FILE)
    lines.mapInArrow(writer, "files long").write.format("noop").mode("overwrite").save()
    mark_complete(spark, path)


def _write_files(
    batches: Iterator[pa.RecordBatch], folder: str, header: str, most: int
) -> Iterator[pa.RecordBatch]:
    """Sorted rows of sensor and line to files of at most ``most`` lines; yields how many files."""
    task = TaskContext.get()
    rows = chain.from_iterable(zip(*(c.to_pylist() for c in b.columns), strict=True) for b in batches)
    files = 0
    for sensor, lines in groupby(rows, itemgetter(0)):
        place = f"{folder}/sensor_id={_folder_name(sensor)}"
        os.makedirs(place, exist_ok=True)
        for number, first in enumerate(lines):
            name = f"part-{task.partitionId():05d}.c{number:03d}.csv"
            hidden = f"{place}/.{name}.{task.taskAttemptId()}"
            with open(hidden, "w", encoding="utf-8", newline="") as out:
                out.write(f"{header}\n{first[1]}\n")
                out.writelines(f"{line}\n" for _, line in islice(lines, most - 1))
            os.replace(hidden, f"{place}/{name}")
            files += 1
    yield pa.RecordBatch.from_pydict({"files": [files]})


def _folder_name(value: str | None) -> str:
    """A value as Spark's readers expect it in a folder's name."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of an export.

    With a schema the files are listed once, and none is opened for its header. Spark
    puts few small files into a task; no more tasks than a shuffle has are enough.
    """
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))


def export_counts(requested: DataFrame, df: DataFrame) -> DataFrame:
    """How many of the requested sensors have rows, how many have none."""
    present = df.select("sensor_id").distinct().withColumn("has_rows", F.lit(True))
    sensors = requested.select("sensor_id").distinct().join(present, "sensor_id", "left")
    return sensors.agg(
        F.count_if(F.col("has_rows")).alias("successful"),
        F.count_if(F.col("has_rows").isNull()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def build_sensor_map(sensors: DataFrame, order: list[str] = ARRIVAL) -> DataFrame:
    """Sensor to location, one row per sensor: the last one listed."""
    require(sensors, order, "listed sensors")
    pairs = sensors.select("sensor_id", "location_id", *order)
    return last_per_key(pairs, ["sensor_id"], order).select("sensor_id", "location_id")


def write_sensor_map(sensor_map: DataFrame, path: str, merge: bool = False) -> None:
    """Sorted CSV in the next version folder below ``path``; ``read_sensor_map`` reads the last.

    With ``merge``, entries of sensors this run does not list are kept. A run that
    dies while writing leaves the previous version in force.
    """
    spark = sensor_map.sparkSession
    current = last_version(spark, path)
    if merge and current:
        stored = read_sensor_map(spark, path)
        kept = stored.join(sensor_map.select("sensor_id"), "sensor_id", "left_anti")
        sensor_map = sensor_map.unionByName(kept)
    target = f"{path}/v={current + 1}"
    sensor_map.orderBy("sensor_id").write.mode("overwrite").option("header", True).csv(target)

