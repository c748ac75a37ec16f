"""Removal of repeated strings with suffix arrays over shards of candidate text.

A string of ``length`` bytes is repeated when it also starts earlier. Windows of
that length agree on a fingerprint: the smallest hash of the short strings in them.
Each chosen fingerprint stands for the run of windows that chose it, and for the
stretch of text those windows cover, its context. So equal windows always lie in
contexts of one fingerprint, and only these need to meet.

1. Texts become rows of fingerprint, hash of the context and place. Contexts that
   repeat an earlier context whole are repeated strings themselves and are settled
   at once: in a task before the shuffle, or after it by sorted order. Several texts of
   one document (null ids above all) may have the same context at the same place, where
   neither is earlier: one of them goes on, and the others take over its spans.
2. Contexts left that share a fingerprint with other contexts are cut from the texts
   and dealt by fingerprint. Tasks lay them end to end in shards, build the suffix
   array by induced sorting, compute common prefixes, and find the windows that
   also start earlier.
3. The spans found are merged per text and cut out.

A fingerprint with very many occurrences, by counts over all texts in a table of
fixed size, is not dealt as one group: its windows become fingerprints of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm import buffers, sketch
from hazeline.llm.store import written
from hazeline.llm.suffixes import common_prefixes, suffix_array

LENGTH = 100
#: Bytes of the strings that fingerprints are hashes of.
GRAM = 32
#: Above so many occurrences, beyond chance, windows are dealt one by one.
CROWD = 50_000
#: A longer text is read in pieces of this size.
PIECE_BYTES = 1 << 20
#: Bytes of context that one suffix array holds about.
SHARD_BYTES = 1 << 20

_U = np.uint64
#: Null ids form one document after all others.
_NO_ID = (1 << 63) - 1
_COUNT_BITS = 7


def _doc(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))


def _row() -> Column:
    """A name of a row; rows with equal id and text share it, and their spans."""
    return F.xxhash64("doc_id", "text")


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def choose(chunk: buffers.Chunk, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows that choose one place: text, first window, windows, fingerprint, context hash.

    Windows never cross texts. Of equal hashes the leftmost is chosen. First windows
    are places in the chunk.
    """
    data, n = chunk.data, len(chunk.data)
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = buffers.prefix_sums(data)
    at = np.arange(n - gram + 1)
    hashes = buffers.stretch(sums, at, at + gram)
    low = _U(0xFFFFFFFF)
    chosen = _sliding_least((hashes & ~low) | at.astype(np.uint64), width) & low
    starts, ends = chunk.bounds[:-1], chunk.bounds[1:]
    windows = np.maximum(ends - starts - length + 1, 0)
    text, place = buffers.within(windows)
    window = starts[text] + place
    picked = chosen[window].astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (picked[1:] != picked[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(window)))
    start, pick = window[first], picked[first]
    context = buffers.stretch(sums, start, start + count + length - 1)
    context = buffers.mix(context + (pick - start).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return text[first], start, count, hashes[pick], context


def _singles(chunk: buffers.Chunk, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each window by itself."""
    first = buffers.stretch(buffers.prefix_sums(chunk.data), start, start + length)
    return first, buffers.stretch(buffers.prefix_sums(chunk.data, second=True), start, start + length)


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[buffers.Chunk, int]]:
    """The column's chunks, a very long text in pieces, with the place where a piece begins.

    Pieces overlap by all but one byte of a window, so each window is in one of them. What a
    window chooses hangs on the window alone; a run of windows that is cut becomes two.
    """
    for chunk in buffers.chunks(column):
        n = len(chunk.data)
        if len(chunk) > 1 or n <= 2 * PIECE_BYTES:
            yield chunk, 0
            continue
        for low in range(0, n - length + 1, PIECE_BYTES):
            data = chunk.data[low : low + PIECE_BYTES + length - 1]
            yield buffers.Chunk(chunk.first, data, np.array([0, len(data)])), low


def crowded_cells(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> np.ndarray:
    """Cells of fingerprints with very many contexts, whole copies in a chunk counted once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.empty()
        for batch in batches:
            for chunk, _ in _pieces(batch.column(0), length):
                *_, print_, context = choose(chunk, length, gram)
                _, once = np.unique(context, return_index=True)
                sketch.count(counts, print_[once])
        blocks = sketch.packed(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], ["part", "counts"]
        )

    parts = docs.select("text").mapInArrow(read, "part int, counts binary")
    return sketch.above_chance(sketch.summed(parts), crowd)


def _spans(start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places where a merged span begins, for spans sorted by owner and start with growing ends."""
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > end[:-1])
    return np.flatnonzero(new)


def occurrences(docs: DataFrame, crowded: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """print, context, doc, place, row: one row per chosen fingerprint, and settled spans.

    ``place`` packs start and number of windows; ``row`` names the text. Contexts that a
    chunk of texts has already had, earlier in the order of documents, are merged
    into spans: rows with a negative place, whose context is the end.
    """
    asked = docs.select(_doc().alias("doc"), _row().alias("row"), "text")
    packed = np.packbits(crowded).tobytes()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        for batch in batches:
            doc, row = (batch.column(i).to_numpy() for i in (0, 1))
            for chunk, low in _pieces(batch.column(2), length):
                text, start, count, print_, context = choose(chunk, length, gram)
                crowd = hot[sketch.cells_of(print_)]
                if crowd.any():
                    owner, place = buffers.within(count[crowd])
                    one = start[crowd][owner] + place
                    a, b = _singles(chunk, one, length)
                    text, start = (np.append(x[~crowd], y) for x, y in ((text, text[crowd][owner]), (start, one)))
                    count = np.append(count[~crowd], np.ones(len(one), np.int64))
                    print_, context = np.append(print_[~crowd], a), np.append(context[~crowd], b)
                id_, local = doc[chunk.first + text], start - chunk.bounds[text] + low
                named = row[chunk.first + text]
                place = (local << _COUNT_BITS) | count
                order = np.lexsort((local, id_, context, print_))
                same = np.zeros(len(order), bool)
                p, c = print_[order], context[order]
                same[1:] = (p[1:] == p[:-1]) & (c[1:] == c[:-1])
                head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                again = np.zeros(len(order), bool)
                again[order] = same & ((id_[order] != id_[head]) | (local[order] != local[head]))
                settled = np.flatnonzero(again)
                settled = settled[np.lexsort((local[settled], chunk.first + text[settled]))]
                begin = local[settled]
                end = np.zeros(0, np.int64)
                if len(settled):
                    end = begin + count[settled] + length - 1
                    at = _spans(begin, end, text[settled])
                    end = np.maximum.reduceat(end, at)
                    settled, begin = settled[at], begin[at]
                owner = named[settled]
                mark = -1 - (begin << _COUNT_BITS)
                spread = buffers.mix(owner.astype(np.uint64) + begin.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(print_[~again], spread).view(np.int64)),
                        pa.array(np.append(context[~again].view(np.int64), end)),
                        pa.array(np.append(id_[~again], id_[settled])),
                        pa.array(np.append(place[~again], mark)),
                        pa.array(np.append(named[~again], owner)),
                    ],
                    ["print", "context", "doc", "place", "row"],
                )

    return asked.mapInArrow(read, "print long, context long, doc long, place long, row long")


class _Meeting:
    """Walks rows sorted by print, context, doc and place, batch after batch."""

    def __init__(self):
        self.last = None  # print, context, doc, start, name of the context's first row
        self.waiting = None  # the only context so far of the last print: doc, place, name
        self.several = False

    def take(self, print_: np.ndarray, context: np.ndarray, doc: np.ndarray, place: np.ndarray, row: np.ndarray):
        """Rows that repeat a whole context, and rows (with waiting ones) whose print has several contexts.

        Also rows of other texts with the context at the first one's place, and the name of the first for each row.
        """
        n = len(print_)
        start = place >> _COUNT_BITS
        goes_on = self.last is not None and self.last[0] == print_[0]
        same_context = goes_on and self.last[1] == context[0]
        new_print = np.ones(n, bool)
        new_print[1:] = print_[1:] != print_[:-1]
        new_print[0] = not goes_on
        head = np.ones(n, bool)
        head[1:] = new_print[1:] | (context[1:] != context[:-1])
        head[0] = not same_context
        at = np.maximum.accumulate(np.where(head, np.arange(n), -1))
        first_doc = np.where(at >= 0, doc[at], self.last[2] if goes_on else 0)
        first_start = np.where(at >= 0, start[at], self.last[3] if goes_on else 0)
        first_row = np.where(at >= 0, row[at], self.last[4] if goes_on else 0)
        again = ~head & ((doc != first_doc) | (start != first_start))
        beside = ~head & ~again & (row != first_row)
        group = np.cumsum(new_print) - new_print[0]
        heads = np.bincount(group, head)
        if goes_on:
            before = 2 if self.several else 1
            heads[0] += before
        meets = head & (heads[group] > 1)
        released = None
        if goes_on and not self.several and heads[0] > 1:
            released = (int(print_[0]), *self.waiting)
        last = group == group[-1]
        tail = int(heads[-1])
        if tail == 1 and not (goes_on and group[-1] == 0):
            i = int(np.flatnonzero(last & head)[0])
            self.waiting = (int(doc[i]), int(place[i]), int(row[i]))
        self.several = tail > 1
        self.last = (int(print_[-1]), int(context[-1]), int(first_doc[-1]), int(first_start[-1]), int(first_row[-1]))
        return again, meets, released, beside, first_row


def meet(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """print, row, start, size, first: spans to remove (print null), and contexts to compare.

    With ``first``, a context that is the same as that of the row so named at the same place
    of the same document, and has the spans that are found there.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["print", "context", "doc", "place"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Meeting()

        def sized(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return place >> _COUNT_BITS, (place & ((1 << _COUNT_BITS) - 1)) + length - 1

        def made(print_, row, start, size, first) -> pa.RecordBatch:
            none = pa.nulls(len(row), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none if x is None else pa.array(x.astype(np.int64)) for x in (print_, row, start, size, first)],
                ["print", "row", "start", "size", "first"],
            )

        for batch in batches:
            print_, context, doc, place, row = (batch.column(i).to_numpy() for i in range(5))
            span = place < 0
            start = (-1 - place[span]) >> _COUNT_BITS
            yield made(None, row[span], start, context[span] - start, None)
            plain = ~span
            if plain.any():
                print_, context, doc, place, row = (x[plain] for x in (print_, context, doc, place, row))
                again, meets, released, beside, first = state.take(print_, context, doc, place, row)
                yield made(None, row[again], *sized(place[again]), None)
                yield made(print_[beside], row[beside], *sized(place[beside]), first[beside])
                yield made(print_[meets], row[meets], *sized(place[meets]), None)
                if released:
                    print_, _, place, row = (np.array([x], np.int64) for x in released)
                    yield made(print_, row, *sized(place), None)

    dealt = rows.repartition(parts, "print").sortWithinPartitions(*order)
    return dealt.mapInArrow(read, "print long, row long, start long, size long, first long")


def cut_contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """print, doc, row, start, bytes of the contexts in ``wanted``.

    Repeated rows share ``row`` and their contexts: a task cuts them once for each batch, and
    ``compare_contexts`` takes them once.
    """
    asked = wanted.groupBy("row").agg(F.collect_list(F.struct("print", "start", "size")).alias("cuts"))
    texts = docs.select(_doc().alias("doc"), _row().alias("row"), F.col("text").cast("binary").alias("text"))
    rows = texts.join(asked, "row").select("doc", "row", "text", "cuts")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.zeros(0, np.int64)
        for batch in batches:
            names = batch.column(1).to_numpy()
            _, once = np.unique(names, return_index=True)
            once = np.sort(once[~np.isin(names[once], before)])
            batch, before = batch.take(pa.array(once)), names
            cuts = batch.column(3)
            counts = np.diff(cuts.offsets.to_numpy())
            print_, start, size = (cuts.flatten().field(i).to_numpy() for i in range(3))
            for chunk in buffers.chunks(batch.column(2), 1 << 20):
                low, high = counts[: chunk.first].sum(), counts[: chunk.first + len(chunk)].sum()
                owner = np.repeat(np.arange(len(chunk)), counts[chunk.first : chunk.first + len(chunk)])
                upto = np.cumsum(size[low:high])
                # As many contexts at a time as make about a piece.
                for at_once in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(upto // PIECE_BYTES)) + 1):
                    mine = low + at_once
                    at = chunk.bounds[owner[at_once]] + start[mine]
                    piece, inner = buffers.within(size[mine])
                    data = chunk.data[at[piece] + inner]
                    offsets = np.append(0, np.cumsum(size[mine])).astype(np.int32)
                    at_row = pa.array(chunk.first + owner[at_once])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(print_[mine]),
                            batch.column(0).take(at_row),
                            batch.column(1).take(at_row),
                            pa.array(start[mine]),
                            pa.BinaryArray.from_buffers(
                                pa.binary(),
                                len(mine),
                                [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
                            ),
                        ],
                        ["print", "doc", "row", "start", "bytes"],
                    )

    return rows.mapInArrow(read, "print long, doc long, row long, start long, bytes binary")


def repeated_windows(
    data: np.ndarray, bounds: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int
) -> np.ndarray:
    """Which windows of the contexts ``data[bounds[i]:bounds[i + 1]]`` also start earlier, by byte of ``data``."""
    order = suffix_array(data, length)
    context = np.repeat(np.arange(len(doc)), np.diff(bounds))
    inside = np.arange(len(data)) + length <= bounds[context + 1]
    order = order[inside[order]]  # whole windows only
    shared = common_prefixes(data, order, length)
    group = np.cumsum(shared[order] < length) - 1
    where = start[context[order]] + order - bounds[context[order]]
    rank = np.empty(len(order), np.int64)  # of windows by document and place
    by = np.lexsort((where, doc[context[order]]))
    d, w = doc[context[order]][by], where[by]
    new = np.ones(len(by), bool)
    new[1:] = (d[1:] != d[:-1]) | (w[1:] != w[:-1])
    rank[by] = np.cumsum(new)
    again = np.zeros(len(data), bool)
    if len(order):
        least = np.minimum.reduceat(rank, np.flatnonzero(np.append(True, group[1:] != group[:-1])))
        again[order] = rank > least[group]
    return again


def compare_contexts(contexts: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """print, row, place, start, size of spans that the contexts of a fingerprint have earlier elsewhere.

    ``place`` is where the context begins.
    """
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contexts.repartition(parts, "print").sortWithinPartitions("print", "row", "start")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts of repeated rows once; they lie side by side."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.column_stack([batch.column(c).to_numpy() for c in ("print", "row", "start")])
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]).any(axis=1)
            new[0] = last is None or (names[0] != last).any()
            last = names[-1]
            if new.any():
                yield batch if new.all() else batch.filter(pa.array(new))

    def solve(batch: pa.Table) -> pa.RecordBatch:
        batch = batch.combine_chunks()
        column = batch.column("bytes").combine_chunks()
        chunk = next(buffers.chunks(column, 1 << 31))
        print_, doc, row, start = (batch.column(c).to_numpy() for c in ("print", "doc", "row", "start"))
        again = repeated_windows(chunk.data, chunk.bounds, doc, start, length)
        hit = np.flatnonzero(again)
        owner = np.searchsorted(chunk.bounds, hit, "right") - 1
        at = _spans(hit, hit + length, owner) if len(hit) else hit
        first, last = hit[at], hit[np.append(at[1:], len(hit)) - 1] if len(hit) else hit
        owner = owner[at]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(print_[owner]),
                pa.array(row[owner]),
                pa.array(start[owner]),
                pa.array(start[owner] + first - chunk.bounds[owner]),
                pa.array(last - first + length),
            ],
            ["print", "row", "place", "start", "size"],
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in distinct(batches):
            print_ = batch.column(0).to_numpy()
            lengths = np.cumsum(pa.compute.binary_length(batch.column(4)).to_numpy())
            low = 0
            # cut where enough has gathered and the fingerprint changes
            for i in np.flatnonzero(np.append(True, print_[1:] != print_[:-1])).tolist():
                gathered = size + (int(lengths[i - 1]) if i else 0) - (int(lengths[low - 1]) if low else 0)
                fresh = i > 0 or not held or held[-1].column(0)[-1].as_py() != print_[0]
                if fresh and gathered >= shard_bytes:
                    held.append(batch.slice(low, i - low))
                    yield solve(pa.Table.from_batches([b for b in held if b.num_rows]))
                    held, size, low = [], 0, i
            held.append(batch.slice(low))
            size += int(lengths[-1]) - (int(lengths[low - 1]) if low else 0) if len(lengths) else 0
        held = [b for b in held if b.num_rows]
        if held:
            yield solve(pa.Table.from_batches(held))

    return dealt.mapInArrow(read, "print long, row long, place long, start long, size long")


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """row, spans: for each text with repeats the spans (start, size) to remove, in bytes, unmerged.

    ``row`` is a hash of id and text. A byte goes when a string of
    ``length`` bytes that covers it also starts earlier: in a document with a smaller
    id, or earlier in its own. Spans never cross documents, and strings are judged on
    the input. Rows with one id are one document of which only earlier starts count;
    null ids come after all others; null, empty and short texts have no spans.
    """
    rows = occurrences(docs, crowded_cells(docs, length, gram, crowd), length, gram)
    met = written(meet(rows, length), "met")
    settled = met.where("print is null").select("row", "start", "size")
    contexts = cut_contexts(docs, met.where("print is not null and first is null"))
    found = written(compare_contexts(contexts, length, shard_bytes), "repeats")
    beside = met.where("first is not null").select("print", F.col("first").alias("of"), F.col("start").alias("place"), "row")
    shared = found.withColumnRenamed("row", "of").join(beside, ["print", "of", "place"]).select("row", "start", "size")
    return settled.union(found.select("row", "start", "size")).union(shared).groupBy("row").agg(
        F.collect_list(F.struct("start", "size")).alias("spans")
    )


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, the number of removed bytes and of maximal removed runs."""
    kept, end, removed, runs = [], 0, 0, 0
    for start, size in sorted(spans):
        if start > end or not runs:
            kept.append(text[end:start])
            runs += 1
            removed += size
            end = start + size
        elif start + size > end:
            removed += start + size - end
            end = start + size
    kept.append(text[end:])
    return b"".join(kept), removed, runs


def digests(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is left, for each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        _row().alias("row"),
    ).join(spans, "row", "left").select("doc_id", "text", "spans")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                if found.is_valid:
                    found = found.values
                    pairs = zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)
                    left, removed, runs = cut_out(text, list(pairs))
                else:
                    left, removed, runs = text, 0, 0
                out.append((len(text), removed, runs, hashlib.sha256(left).hexdigest()))
            size, removed, runs, digest = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (size, removed, runs)), pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(read, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
