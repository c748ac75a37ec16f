"""Sharding by a lookup table that shards fill in turns.

Every shard has a preference order over the slots of a prime-sized table: a
starting slot and a step, both from a digest of its name, and as the size is
prime every step visits all slots. The shards take turns claiming their next
free slot until the table is full. A row's key hashes to a slot, and the slot's
owner is its shard. Shares differ by at most one slot, and when a shard is added
or removed most slots keep their owner.

The table is built on the driver; its size is a parameter and does not depend on
the data. It is broadcast and placement is one lookup by slot, without a shuffle,
so a key with a third of all rows costs nothing extra.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: At least a hundred slots a shard keep the shares within one per cent.
TABLE_SIZE = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """The owner of each slot, as an index into ``shards``.

    Raises ValueError when there is no shard, when two have one name, when the
    size is not prime, or when there are more shards than slots.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime and not below the number of shards")
    at = [_digest(f"offset:{name}") % size for name in shards]
    step = [_digest(f"skip:{name}") % (size - 1) + 1 if size > 2 else 1 for name in shards]
    owner, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key; a null key is placed like the text ``null``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    return (head % size).cast("int")


def assign_shards(
    df: DataFrame,
    key: str = "doc_id",
    shards: tuple[str, ...] = SHARDS,
    size: int = TABLE_SIZE,
) -> DataFrame:
    """Add ``slot`` and ``shard`` (names; existing columns of these names give way).

    Equal keys share a shard, rows are never dropped or merged, an empty table
    gives an empty table. Key order and partitioning do not matter.
    """
    # From Arrow it is a local table; from tuples, tasks would start Python workers to read it.
    owned = [shards[owner] for owner in fill_table(shards, size)]
    owners = df.sparkSession.createDataFrame(
        pa.table({"slot": pa.array(range(len(owned)), pa.int32()), "shard": pa.array(owned, pa.string())}),
        T.StructType().add("slot", "integer").add("shard", "string"),
    )
    rows = df.drop("slot", "shard").withColumn("slot", slot_of(df[key], size))
    return rows.join(F.broadcast(owners), "slot").select(*rows.columns, "shard")


def write_shards(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write one folder per shard; large shards become several files.

    Rows go to files without a shuffle by shard, so no task holds a whole shard.
    """
    df.write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
