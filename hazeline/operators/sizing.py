"""Lookup joins: broadcast behind a measured size, skew-proof shuffle beyond it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than one task should get.
HOT_ROWS = 500_000
_SALT, _HOT, _FOUND, _LISTED = "_salt", "_hot", "_found", "_listed"


def measured(frames: list[DataFrame]) -> list[tuple[int, int]]:
    """Bytes in memory and rows of each frame, counted in one job.

    The count is over real rows and real text lengths, not over file sizes,
    which say little about compressed columns.
    """
    totals = []
    for number, frame in enumerate(frames):
        texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
        fixed = F.lit(16 + 8 * len(frame.columns))
        varying = sum((F.coalesce(F.octet_length(c), F.lit(0)) + 8 for c in texts), F.lit(0))
        size = F.sum((varying + fixed).cast("long")).alias("size")
        counted = frame.agg(size, F.count(F.lit(1)).alias("rows"))
        totals.append(counted.select(F.lit(number).alias("number"), "size", "rows"))
    # One row per frame.
    rows = reduce(DataFrame.unionAll, totals).collect()
    sizes = {row["number"]: (row["size"] or 0, row["rows"]) for row in rows}
    return [sizes[number] for number in range(len(frames))]


def lookup_join(
    df: DataFrame, lookup: DataFrame, key: str, spread_by: list[str], limit: int | None = None
) -> DataFrame:
    """Left join of rows to a lookup that is unique by ``key``, whatever the skew.

    Beyond ``limit`` bytes, BROADCAST_BYTES unless given, the rows are shuffled, but
    no key may fill a task: keys with more than HOT_ROWS rows find their lookup rows
    in a broadcast, and their rows, like those without a key, are spread by a hash of
    the ``spread_by`` columns. Only the other rows meet the shuffled lookup. The
    broadcast takes the most frequent of these keys that the limit has room for, so a
    key left out has fewer rows than all rows divided by that many keys.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    [(size, rows)] = measured([lookup])
    if size <= limit:
        return df.join(F.broadcast(lookup), key, "left")
    columns = [c for c in lookup.columns if c != key]
    room = max(1, limit * rows // size)
    frequent = _most_frequent(df, key, room)
    # ``room`` rows at most, as the lookup is unique.
    matches = lookup.join(F.broadcast(frequent), key, "left_semi")
    found = F.struct(*columns).alias(_FOUND) if columns else F.lit(True).alias(_FOUND)
    matches = matches.select(key, found)
    hot = frequent.join(F.broadcast(matches), key, "left").withColumn(_HOT, F.lit(True))
    marked = df.join(F.broadcast(hot), key, "left")
    # The second join key follows the first, but for rows that were served.
    by_key = F.xxhash64(key)
    served = F.col(_HOT) | F.col(key).isNull()
    marked = marked.withColumn(_SALT, F.when(served, F.xxhash64(*spread_by)).otherwise(by_key))
    plain = lookup.withColumn(_SALT, by_key).hint("merge")
    joined = marked.join(plain, [key, _SALT], "left")
    picked = {c: F.when(F.col(_HOT), F.col(f"{_FOUND}.{c}")).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(picked).drop(_SALT, _HOT, _FOUND)


def keep_listed(
    df: DataFrame, listed: DataFrame, key: str, spread_by: list[str] | None = None
) -> DataFrame:
    """Rows whose key is in a list table: a semi join with the same care."""
    flags = listed.select(key).distinct().withColumn(_LISTED, F.lit(True))
    spread_by = spread_by or [c for c in df.columns if c != key]
    return lookup_join(df, flags, key, spread_by).where(_LISTED).drop(_LISTED)


def _most_frequent(df: DataFrame, key: str, room: int) -> DataFrame:
    """The keys with more than HOT_ROWS rows, the ``room`` most frequent of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > HOT_ROWS).orderBy(F.col("_n").desc(), key).limit(room).select(key)
