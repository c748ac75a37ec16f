"""Exact medians of a few very large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# One in so many rows is the error of the sketch that brackets the middle.
ACCURACY = 100_000


def exact_median(rows: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Median by keys, for few groups of any size and any distribution of values.

    A sketch of each group, merged from all tasks, gives two values that surely
    enclose the middle. Rows below them are only counted; those between, about one
    in ten thousand, and however many are equal, are counted by value and ranked.
    So a second reading replaces a shuffle of the rows, and no task ranks more
    than that small part of a group.
    """
    slack = 5 / ACCURACY
    present = rows.where(F.col(value).isNotNull())
    sketched = present.groupBy(*keys).agg(
        F.percentile_approx(value, [0.5 - slack, 0.5 + slack], ACCURACY).alias("_bracket"),
        F.count(F.lit(1)).alias("_total"),
    )
    # One row per group, and groups are few.
    near = present.join(F.broadcast(sketched), keys)
    low, high = F.col("_bracket")[0], F.col("_bracket")[1]
    near = near.where(F.col(value) <= high)
    # All that lies below the bracket is one row, which sorts first.
    counted = near.groupBy(*keys, "_total", F.when(F.col(value) >= low, F.col(value)).alias("_value"))
    counted = counted.agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*keys).orderBy(F.col("_value").asc_nulls_first())
    ranked = counted.withColumn(
        "_upto", F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )

    def at(rank: str):
        r = F.expr(rank)
        return F.max(F.when((F.col("_upto") >= r) & (F.col("_upto") - F.col("_n") < r), F.col("_value")))

    middle = (at("(_total + 1) div 2") + at("_total div 2 + 1")) / 2
    return ranked.groupBy(*keys).agg(middle.alias("median"))
