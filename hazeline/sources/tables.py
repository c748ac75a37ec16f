"""Stored tables on plain Parquet: the fact table and snapshot tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.functions.dates import month_key
from hazeline.functions.numbers import no_nan
from hazeline.schemas import FACT, KEY, MANIFEST, SENSOR_METADATA, SIGNAL, STORED_FACT, require
from hazeline.sources.files import last_version, versions

# Files that a month of one batch is dealt to. Fit for small tables; a table that takes
# tens of gigabytes a day wants some hundreds.
BUCKETS = 8

# The measurement columns that reports need.
_REPORT_COLUMNS = [
    c for c in FACT.names if c not in ("coverage_percent", "min", "max", "median")
]


def scan_parameter(facts: DataFrame, parameter: str = "pm25") -> DataFrame:
    """Measurements of one parameter, with the columns reports need.

    There is no sort: reports order what they show. The month comes along if
    there is one, so that date filters can skip partitions.
    """
    kept = [c for c in [*_REPORT_COLUMNS, "month"] if c in facts.columns]
    rows = facts.where(F.col("parameter") == parameter).select(*kept)
    doubles = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rows.withColumns({name: no_nan(F.col(name)) for name in doubles})


class SnapshotTable:
    """A small table replaced as a whole, in folders ``v=1``, ``v=2``, …

    The newest folder with a commit marker is the table. A job that dies while
    writing leaves the previous one in force.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def version(self) -> int:
        return last_version(self.spark, self.path)

    def read(self) -> DataFrame:
        current = self.version()
        if current == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={current}")

    def replace(self, rows: DataFrame) -> None:
        """Write the next version; ``rows`` may be derived from this one."""
        target = f"{self.path}/v={self.version() + 1}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(target)


class UsedBatchName(ValueError):
    """A batch name that stands for other input already."""


class FactTable:
    """Measurements below ``path/data``, in folders that ``path/log`` lists.

    Each write of a batch goes to a folder of its own, ``attempt=…/month=…``. Only
    the next commit makes it count, and takes the batch's earlier folders out, so
    a retry adds nothing twice, a shorter rerun leaves no month behind, and a job
    that died leaves nothing readers see. A batch also keeps what its input was:
    its name cannot be used for other input. One writer at a time may write.

    Rows are dealt to ``buckets`` files by a hash of the whole key, as Spark's own
    bucketed tables are, so a merge reads stored keys where they lie and moves only
    the batch, and a sensor with a third of all rows is spread like any other. Inside
    a file rows are sorted by sensor and time, with a Bloom filter on the sensor, so a
    reader of few sensors skips most row groups. The number of buckets is the table's
    for good; later sessions take it from the log.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.data = spark, path, f"{path}/data"
        self.log, self._buckets = CommitLog(spark, f"{path}/log"), buckets

    @property
    def buckets(self) -> int:
        return next((entry.buckets for entry in self.log.entries()), self._buckets)

    def _folders(
        self, ranges: dict[str, tuple[dt.datetime, dt.datetime]] | None, skip_batch: str | None
    ) -> list[tuple[str, str]]:
        """Attempt and month of the folders a reader needs; of a write, one month may count and another not."""
        held = [e for e in self.log.entries() if e.attempt and (skip_batch is None or e.batch != skip_batch)]
        if ranges is not None:
            spans = {month: (_naive(low), _naive(high)) for month, (low, high) in ranges.items()}
            held = [e for e in held if e.month in spans and e.high >= spans[e.month][0] and e.low <= spans[e.month][1]]
        return sorted({(e.attempt, e.month) for e in held})

    def read(
        self,
        ranges: dict[str, tuple[dt.datetime, dt.datetime]] | None = None,
        skip_batch: str | None = None,
    ) -> DataFrame:
        """Stored rows; with ``ranges``, by month, only those between two times."""
        held = self._folders(ranges, skip_batch)
        if not held:
            return self.spark.createDataFrame([], STORED_FACT)
        folders = [f"{self.data}/attempt={a}/month={m}" for a, m in held]
        reader = self.spark.read.schema(_WITH_ATTEMPT).option("basePath", self.data)
        return _between(reader.parquet(*folders).drop("attempt"), ranges, skip_batch)

    @contextmanager
    def dealt(
        self,
        ranges: dict[str, tuple[dt.datetime, dt.datetime]] | None = None,
        skip_batch: str | None = None,
    ) -> Iterator[DataFrame]:
        """The rows of ``read`` as a bucketed table, which joins and groups by the key without a shuffle.

        Only the catalog knows of buckets, so the folders are a table of it as long as the block runs.
        """
        held = self._folders(ranges, skip_batch)
        if not held:
            yield self.spark.createDataFrame([], STORED_FACT)
            return
        name = _scratch_name()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _WITH_ATTEMPT.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (month, attempt)"
            f" CLUSTERED BY ({', '.join(KEY)}) INTO {self.buckets} BUCKETS LOCATION '{self.data}'"
        )
        try:
            parts = [
                f"PARTITION (month = '{m}', attempt = '{a}') LOCATION '{self.data}/attempt={a}/month={m}'" for a, m in held
            ]
            for at in range(0, len(parts), 500):
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[at : at + 500])}")
            yield _between(self.spark.table(name).drop("attempt"), ranges, skip_batch)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files are not the catalog's

    def claim(self, batch: str, source: str) -> None:
        """Refuse a batch name that stands for other input, or whose rows were compacted."""
        held = [e for e in self.log.entries() if e.batch == batch]
        if any(e.source != source for e in held):
            raise UsedBatchName(f"batch {batch!r} holds other input already")
        if any(e.compacted for e in held):
            raise UsedBatchName(f"batch {batch!r} is compacted and cannot be replaced")

    def append(
        self,
        rows: DataFrame,
        batch: str,
        source: str = "",
        as_of: dt.datetime | None = None,
        dealt: bool = False,
    ) -> int:
        """Write accepted rows as one batch, in place of what it held; returns their number.

        ``source`` tells what the rows were made of. ``dealt`` rows are hashed by the key
        into the table's buckets already. The number of rows and the days they cover are
        observed by the writing tasks, once each however often a task ran.
        """
        require(rows, FACT.names, "accepted rows")
        self.claim(batch, source)
        created = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
        stored = rows.select(
            *FACT.names,
            created.alias("created_at"),
            F.lit(batch).alias("batch"),
            month_key(F.col("datetime_utc")).alias("month"),
        )
        attempt, count, days = self._write(stored, dealt)
        about = {"batch": batch, "source": source, "compacted": False, "buckets": self.buckets}
        mark = Entry(rows=count, **about)
        self.log.commit([mark, *_months(attempt, days, about)])
        return count

    def _write(self, stored: DataFrame, dealt: bool = False) -> tuple[str, int, list[dt.date]]:
        """Write rows to a new folder; its name, the number of rows, and the days they are of."""
        attempt, name, seen = uuid.uuid4().hex, _scratch_name(), Observation()
        rows = stored if dealt else stored.repartition(self.buckets, *KEY)
        rows = rows.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.date_format("datetime_utc", "yyyy-MM-dd")).alias("days")
        )
        writer = rows.write.format("parquet").partitionBy("month").bucketBy(self.buckets, *KEY)
        writer = writer.sortBy("sensor_id", "datetime_utc").option("parquet.bloom.filter.enabled#sensor_id", True)
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", True)
        writer.option("path", f"{self.data}/attempt={attempt}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files are not the catalog's
        return attempt, seen.get["rows"], [dt.date.fromisoformat(day) for day in seen.get["days"]]

    def compact(self, months: list[str]) -> None:
        """Rewrite the named months into one folder.

        Their batches can no longer be replaced, but their names stay taken. In the log
        a compacted month is one entry, whatever batches it came from.
        """
        listed = self.log.entries()
        rows = self.read().where(F.col("month").isin(months)).select(*_WITH_ATTEMPT.names[:-1])
        attempt, _, days = self._write(rows)
        inside = {e.batch for e in listed if e.month in months}
        kept = [
            e._replace(compacted=e.compacted or e.batch in inside) for e in listed if e.month is None or e.month not in months
        ]
        about = {"batch": None, "source": None, "compacted": True, "buckets": self.buckets}
        self.log.replace([*kept, *_months(attempt, days, about)])

    def rows_in_batch(self, batch: str) -> int:
        return sum(e.rows for e in self.log.entries() if e.batch == batch and e.rows)


class Entry(NamedTuple):
    """A row of the log; see ``schemas.MANIFEST``."""

    number: int | None = None
    batch: str | None = None
    source: str | None = None
    attempt: str | None = None
    month: str | None = None
    low: dt.datetime | None = None
    high: dt.datetime | None = None
    rows: int | None = None
    compacted: bool = False
    buckets: int | None = None


class CommitLog:
    """Commits of a table, each a small folder ``c=n``; every FOLD of them a whole state ``w=n``.

    A reader takes the last whole state and the few commits after it, so neither a commit
    nor a reader pays for all that came before. The last commit of a batch holds for it.
    Entries pass the driver: one per batch, and per folder that is not compacted yet.
    """

    FOLD = 32

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._known: tuple[list[str], list[Entry]] | None = None

    def _folders(self) -> list[str]:
        whole = next(versions(self.spark, self.path, "w"), 0)
        later = sorted(n for n in versions(self.spark, self.path, "c") if n > whole)
        return [f"w={whole}"] * bool(whole) + [f"c={n}" for n in later]

    def entries(self) -> list[Entry]:
        """What holds now. Folders never change, so equal names mean equal entries."""
        names = self._folders()
        if self._known is None or self._known[0] != names:
            paths = [f"{self.path}/{name}" for name in names]
            rows = self.spark.read.schema(MANIFEST).parquet(*paths).collect() if paths else []
            self._known = names, _in_force([Entry(*row) for row in rows])
        return self._known[1]

    def commit(self, entries: list[Entry]) -> None:
        before, number = self.entries(), self._next()
        self._write(f"c={number}", [e._replace(number=number) for e in entries])
        after = _in_force([*before, *(e._replace(number=number) for e in entries)])
        if number % self.FOLD == 0:
            self._write(f"w={number}", after)
        self._known = self._folders(), after

    def replace(self, entries: list[Entry]) -> None:
        """Make these the whole state."""
        number = self._next()
        self._write(f"w={number}", [e._replace(number=e.number or number) for e in entries])

    def _next(self) -> int:
        return 1 + max(next(versions(self.spark, self.path, kind), 0) for kind in "wc")

    def _write(self, name: str, entries: list[Entry]) -> None:
        rows = self.spark.createDataFrame(entries, MANIFEST).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}")


def _in_force(entries: list[Entry]) -> list[Entry]:
    last = {}
    for e in entries:
        last[e.batch] = max(last.get(e.batch, 0), e.number)
    return [e for e in entries if e.batch is None or e.number == last[e.batch]]


def _months(attempt: str, days: list[dt.date], about: dict) -> list[Entry]:
    """An entry for each month with the first and the last moment of its days."""
    spans = sorted(month_ranges(days).items())
    return [Entry(attempt=attempt, month=month, low=low, high=high, **about) for month, (low, high) in spans]


def month_ranges(days: list[dt.date]) -> dict[str, tuple[dt.datetime, dt.datetime]]:
    """By month, the first and the last moment of the days in it."""
    months = {}
    for day in days:
        months.setdefault(f"{day:%Y-%m}", []).append(day)
    ends = dt.time.min, dt.time.max
    return {m: (dt.datetime.combine(min(d), ends[0]), dt.datetime.combine(max(d), ends[1])) for m, d in months.items()}


def _between(rows: DataFrame, ranges: dict | None, skip_batch: str | None) -> DataFrame:
    """Rows between two times, by month, and of other batches."""
    if skip_batch is not None:  # a compacted folder has rows of several batches
        rows = rows.where(F.col("batch") != skip_batch)
    if ranges is None:
        return rows
    stamp = F.col("datetime_utc")
    inside = [
        (F.col("month") == month)
        & stamp.between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))
        for month, (low, high) in ranges.items()
    ]
    lows, highs = zip(*ranges.values(), strict=True)
    # The overall range is one that file statistics can answer.
    return rows.where(
        (stamp >= F.lit(min(lows)).cast("timestamp_ntz"))
        & (stamp <= F.lit(max(highs)).cast("timestamp_ntz"))
        & reduce(Column.__or__, inside)
    )


def _naive(stamp: dt.datetime) -> dt.datetime:
    return stamp.replace(tzinfo=None)


def _scratch_name() -> str:
    return f"hazeline_{uuid.uuid4().hex}"


# As the files have them, with both folder columns.
_WITH_ATTEMPT = T.StructType([*STORED_FACT.fields, T.StructField("attempt", T.StringType())])

# Table name, its columns, its partition columns.
_TABLES = {
    "sensor_data/data": (_WITH_ATTEMPT, ["attempt", "month"]),
    "sensor_metadata": (SENSOR_METADATA, []),
    "signal_table": (SIGNAL, []),
}


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_tables(spark: SparkSession, root: str, database: str = "default") -> list[str]:
    """Create the catalog tables that are not there yet; returns all names.

    The catalog's fact table shows all folders; ``FactTable`` those that count.
    """
    names = []
    for folder, (schema, partitions) in _TABLES.items():
        table = folder.split("/")[0]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        split = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet{split}"
            f" LOCATION '{root}/{folder}'"
        )
        names.append(f"{database}.{table}")
    return names
