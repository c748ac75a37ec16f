"""Relational database as source and sink, through Spark's JDBC reader.

The database's driver jar must be on the class path of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeline.operators.cleaning import dedup_first
from hazeline.schemas import FACT, KEY


def connection(
    host: str, database: str, user: str, password: str, port: int = 5432, sslmode: str = "require"
) -> dict[str, str]:
    if not all([host, database, user, password]):
        raise ValueError("host, database, user and password are all needed")
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}?sslmode={sslmode}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
    }


def month_predicates(months: list[str]) -> list[str]:
    """One read task per month of the fact table."""
    bounds = []
    for month in sorted(months):
        year, number = (int(part) for part in month.split("-"))
        after = f"{year + number // 12:04d}-{number % 12 + 1:02d}"
        bounds.append(f"datetime_utc >= '{month}-01' AND datetime_utc < '{after}-01'")
    return bounds


def read_table(
    spark: SparkSession, options: dict[str, str], table: str, months: list[str] | None = None
) -> DataFrame:
    """A table in parallel by month, or in one task for small tables."""
    properties = {k: v for k, v in options.items() if k != "url"}
    if months is None:
        return spark.read.jdbc(options["url"], table, properties=properties)
    return spark.read.jdbc(
        options["url"], table, predicates=month_predicates(months), properties=properties
    )


def insert_statement(table: str, side: str) -> str:
    """Moves staged rows into the table; rows it has already are left as they are."""
    columns = ", ".join(f'"{name}"' for name in FACT.names)
    keys = ", ".join(f'"{name}"' for name in KEY)
    return f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {side} ON CONFLICT ({keys}) DO NOTHING"


def append_new(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    batch: DataFrame,
    arrival: list[str],
    side: str,
) -> None:
    """Insert-ignore into a database table.

    The batch's first rows go to a side table, which a retried task or job may
    write again, and one statement moves them over. The table's unique constraint
    decides what is new, also against concurrent writers.
    """
    rows = dedup_first(batch, arrival).select(*FACT.names)
    properties = {k: v for k, v in options.items() if k != "url"}
    rows.write.jdbc(options["url"], side, mode="overwrite", properties=properties)
    manager = spark._jvm.java.sql.DriverManager
    link = manager.getConnection(options["url"], options["user"], options["password"])
    try:
        link.createStatement().executeUpdate(insert_statement(table, side))
    finally:
        link.close()
