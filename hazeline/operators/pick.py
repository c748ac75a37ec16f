"""One row per key, the first or the last by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_pick_rank"


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row of each key.

    Rank filters of this shape cut every task to one row per key before the
    shuffle, so a key that holds a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def last_per_key(df: DataFrame, keys, order) -> DataFrame:
    return first_per_key(df, keys, [_column(c).desc() for c in order])


def _column(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name
