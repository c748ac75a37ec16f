"""Counts of hashes in a fixed number of cells, summed over all tasks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_BITS, PART_BITS = 22, 16
#: Tasks whose counts are added up by one task.
GROUP = 256
_U = np.uint64


def cells_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - CELL_BITS)).astype(np.int64)


def empty() -> np.ndarray:
    return np.zeros(1 << CELL_BITS, np.int32)


def count(counts: np.ndarray, hashes: np.ndarray) -> None:
    """Add hashes to the cells."""
    np.add.at(counts, cells_of(hashes), np.int32(1))


def packed(counts: np.ndarray) -> list[bytes]:
    """The cells in parts, so that no task has to add up all of them."""
    kind = np.uint8 if counts.max() < 256 else np.int32
    return [
        np.dtype(kind).char.encode() + zlib.compress(x.astype(kind).tobytes(), 1)
        for x in counts.reshape(-1, 1 << PART_BITS)
    ]


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), data[:1].decode()).astype(np.int64)


def summed(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' parts (part int, counts binary).

    A part is added up in two steps, first over GROUP tasks at a time, so no task streams
    what all tasks have made.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = _unpacked(data.as_py())
                sums[at] = sums[at] + found if at in sums else found
        blocks = [b"l" + zlib.compress(x.tobytes(), 1) for x in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(blocks, pa.binary())], ["part", "counts"]
        )

    total = np.zeros((1 << (CELL_BITS - PART_BITS), 1 << PART_BITS), np.int64)
    schema = "part int, counts binary"
    group = F.floor(F.spark_partition_id() / GROUP)
    few = parts.select("part", "counts", group.alias("group")).repartition("part", "group")
    dealt = few.select("part", "counts").mapInArrow(add, schema).repartition(len(total), "part")
    for row in dealt.mapInArrow(add, schema).collect():
        total[row["part"]] = _unpacked(bytes(row["counts"]))
    return total.ravel()


def above_chance(counts: np.ndarray, least: float) -> np.ndarray:
    """Cells that hold more than an even spread explains, by ``least`` at any rate."""
    mean = counts.mean()
    return counts > mean + 8 * np.sqrt(mean) + least
