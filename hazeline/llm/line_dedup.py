"""Line dedup: first occurrences streamed from range-partitioned line hashes.

Each line that is long enough becomes a row of two hashes of its key, 128 bits in
all, the document and the place. Lines count as equal by these hashes, which have no
pattern that two lines could share; texts are not compared. The rows are range-partitioned and sorted by hash, document and
place, so a line that a third of all documents share is cut over many partitions.
Each partition is streamed once: the first document of a hash keeps the line, the
others lose it. Where a hash goes on from the partition before, its first document
comes from a summary with one row per partition.

The result are compressed bitmaps of the lines to keep, one per document that
loses any; texts are not shuffled to find them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm import buffers
from hazeline.llm.store import set_checkpoint_dir, written

#: Shorter keys, in code points, never lose a line.
MIN_CHARS = 10

_LINES = "hash long, more long, doc long, place int, n_lines int, row long"
#: Null ids form one document that comes after all others.
_NO_ID = (1 << 63) - 1


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash by which a row's bitmap is found again; rows with equal id and text share it."""
    return F.xxhash64(doc_id, text)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: the stripped line with A to Z lowered."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), row_key().alias("row"), "text"
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, row = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for chunk in buffers.chunks(batch.column(2)):
                text, place, starts, ends = buffers.lines(chunk)
                n_lines = np.bincount(text, minlength=len(chunk))
                starts, ends = buffers.stripped(chunk, starts, ends)
                points = buffers.code_points(chunk)
                long = np.flatnonzero(points[ends] - points[starts] >= min_chars)
                text, starts, ends = text[long], starts[long], ends[long]
                first = buffers.own_hashes(chunk, starts, ends)
                second = buffers.own_hashes(chunk, starts, ends, second=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first.view(np.int64)),
                        pa.array(second.view(np.int64)),
                        pa.array(doc[chunk.first + text]),
                        pa.array(place[long].astype(np.int32)),
                        pa.array(n_lines[text].astype(np.int32)),
                        pa.array(row[chunk.first + text]),
                    ],
                    ["hash", "more", "doc", "place", "n_lines", "row"],
                )

    return rows.mapInArrow(hashed, _LINES)


class _Runs:
    """The first document of each hash in a sorted stream, batch after batch."""

    def __init__(self, key: tuple[int, int] | None, first: int):
        self.key, self.first = key, first

    def firsts(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        hashes, more, doc = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (more[1:] != more[:-1])
        at = np.flatnonzero(new)
        heads = doc[at]
        if self.key == (hashes[0], more[0]):
            heads[0] = self.first
        self.key, self.first = (int(hashes[-1]), int(more[-1])), int(heads[-1])
        return doc, np.repeat(heads, np.diff(np.append(at, len(doc))))


def dropped_lines(lines: DataFrame) -> DataFrame:
    """row, n_lines and place of each line that stands in a smaller document too."""
    set_checkpoint_dir(lines.sparkSession)
    order = ["hash", "more", "doc", "place", "row"]
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order).checkpoint()

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, head = _Runs(None, 0), None
        for batch in batches:
            if batch.num_rows:
                head = head or (int(batch.column(0)[0].as_py()), int(batch.column(1)[0].as_py()))
                runs.firsts(batch)
        if head:
            row = [TaskContext.get().partitionId(), *runs.key, runs.first, runs.key == head]
            names = ["part", "hash", "more", "doc", "one"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], _SUMMARY)

    carried, key, first = {}, None, 0
    for end in sorted(
        dealt.mapInArrow(summary, "part int, hash long, more long, doc long, one boolean").collect(),
        key=lambda e: e["part"],
    ):
        if key is not None:
            carried[end["part"]] = (key, first)
        goes_on = end["one"] and key == (end["hash"], end["more"])
        key, first = (end["hash"], end["more"]), first if goes_on else end["doc"]

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(*carried.get(TaskContext.get().partitionId(), (None, 0)))
        for batch in batches:
            if batch.num_rows:
                doc, first = runs.firsts(batch)
                yield batch.filter(pa.array(doc != first)).select(["row", "n_lines", "place"])

    return dealt.mapInArrow(dropped, "row long, n_lines int, place int")


_SUMMARY = pa.schema(
    [("part", pa.int32()), ("hash", pa.int64()), ("more", pa.int64()), ("doc", pa.int64()), ("one", pa.bool_())]
)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """row, n_dropped and bitmap for each row of ``docs`` that loses a line.

    A line is lost when its key, of ``min_chars`` code points at least, also stands
    in a document with a smaller id; a document keeps its own repeats. ``bitmap``
    is a compressed string of bits, one per line, set where the line stays, and
    ``row`` is ``row_key``. Rows with one id are one document, null ids are one
    document after all others; null and empty texts have one empty line, which
    stays; an empty table has no bitmaps. Ids are whole numbers.
    """
    lost = dropped_lines(written(line_hashes(docs, min_chars), "lines"))
    places = lost.groupBy("row", "n_lines").agg(F.collect_set("place").alias("places"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, counts = [], []
            for n, at in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                keep = np.ones(n, bool)
                keep[at.values.to_numpy()] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
                counts.append(n - int(keep.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())],
                ["row", "n_dropped", "bitmap"],
            )

    return places.mapInArrow(packed, "row long, n_dropped long, bitmap binary")


def kept_text(text: str | None, bitmap: bytes | None) -> str:
    """The lines of a text that its bitmap keeps; all of them without one."""
    text = text or ""
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join(line for line, stays in zip(lines, keep, strict=True) if stays)


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text, for each row of ``docs``."""
    rows = docs.select("doc_id", "text", row_key().alias("of")).join(
        bitmaps, F.col("of") == F.col("row"), "left"
    )
    rows = rows.select("doc_id", "text", "bitmap", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes = [], []
            for text, bitmap in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py() or ""
                counts.append(text.count("\n") + 1)
                hashes.append(hashlib.sha256(kept_text(text, bitmap.as_py()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(3), pa.array(hashes)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string")
