"""N-gram Jaccard join by vertical partitioning, and the groups it links.

A text's set are its distinct five-word shingles. All shingles stand in one global
order: rare before frequent, by a sketch of counts of a fixed size, then by hash.
Any one order gives right results; this one keeps frequent shingles out of the
prefixes. A cell of the sketch holds more shingles the larger the table is, so cells
at the level of chance are in order of their counts, too: a shingle that a hundred
texts have by chance is rarely in a cell with few.

1. Texts with equal sets are one class from the start, so exact copies of a text
   meet no join.
2. Two sets that are similar enough share a shingle within their prefixes, which
   depend on size and threshold only. Prefix shingles are joined to candidate pairs.
   A shingle that many classes have in their prefix makes no pairs: its classes are
   dealt out in blocks, and tasks compare two blocks at a time.
3. A class has a map of bits, one or two for each of its shingles. The bits in which two
   maps differ bound what two sets can share, and rule out most pairs that met by
   chance before a set is copied for them.
   The order is cut into fragments, and each set with it. The overlap of a pair is
   counted fragment by fragment and summed. Pairs that the first fragment already
   rules out go no further. Blocks do the same with slices of a matrix.
4. Links between classes are merged into components.

Nothing is capped or sampled: the sketch, the maps and the filter of classes only decide
how much is shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm import buffers, sketch
from hazeline.llm.components import components
from hazeline.llm.store import written

WORDS = 5
#: Texts are read in pieces of so many bytes; larger ones take more memory and no less time.
CHUNK_BYTES = 1 << 18
#: Similarity as a fraction: shared shingles of all shingles of both.
THRESHOLD = Fraction(80, 100)
#: A shingle with more classes in its prefix bucket is compared in blocks.
PAIR_BUCKET = 64
#: Shingles that one block holds about.
BLOCK_SHINGLES = 1 << 18
#: Classes that one block holds about, however small their sets.
BLOCK_CLASSES = 4096
#: Columns of the matrix slice that a block comparison holds.
SLICE = 2048
#: Tasks that the rows of one crowded token are spread over where they meet its figures.
SALTS = 16
#: Rows of the matrix that a block comparison holds, besides a bit map of the links.
BAND = 512
#: Shingles that are not frequent are cut into so many fragments; frequent ones are one more.
FRAGMENTS = 4

_U = np.uint64
_RANK_BITS, _FILTER_BITS = 5, 23
_HASH_BITS = 64 - _RANK_BITS
#: Ranks of cells at the level of chance, each with about as many shingles; a multiple of FRAGMENTS.
_CHANCE_RANKS = 8
#: Rank of a cell above chance, besides the logarithm of what stands above the mean, which is 5 at least.
_ABOVE = _CHANCE_RANKS - 5
#: Prefix buckets of shingles above this count, by the sketch, are dealt out by class as well.
_SALT_RANK = 17 + _ABOVE


def shingle_sets(chunk: buffers.Chunk, k: int = WORDS) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each text the sorted distinct shingle hashes, and the class they make (0 without shingles)."""
    starts, ends, first = buffers.words(chunk)
    hashes = buffers.word_hashes(chunk, starts, ends)
    grams = buffers.windows(hashes, k)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            x = np.sort(grams[a : b - k + 1])
            sets.append(x[np.append(True, x[1:] != x[:-1])])
        elif b > a:  # the whole sequence is one shingle
            x = (hashes[a:b] * buffers.powers(b - a)).sum(dtype=np.uint64) + _U(b - a)
            sets.append(buffers.mix(np.array([x], np.uint64)))
        else:
            sets.append(grams[:0])
    sizes = np.array([len(x) for x in sets], np.int64)
    sums = np.zeros(int(sizes.sum()) + 1, np.uint64)
    if len(sums) > 1:
        np.cumsum(buffers.mix(np.concatenate(sets)), out=sums[1:])
    to = np.cumsum(sizes)
    classes = buffers.mix(sums[to] - sums[to - sizes] + sizes.astype(np.uint64))
    return sets, np.where(sizes > 0, classes, _U(0)).view(np.int64)


def ordered(shingles: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles as places in the global order, sorted: the rank of their cell, then the hash."""
    rank = ranks[sketch.cells_of(shingles)].astype(np.uint64)
    return np.sort((rank << _U(_HASH_BITS)) | (shingles >> _U(_RANK_BITS)))


def prefix_length(n: int, threshold: Fraction = THRESHOLD) -> int:
    """Two similar sets share one of so many first shingles of either."""
    return n - -(-n * threshold.numerator // threshold.denominator) + 1


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _fresh(classes: np.ndarray, seen: set[int]) -> list[int]:
    """Places of classes that this task has not met yet; those without shingles are left out."""
    out = []
    for i, c in enumerate(classes.tolist()):
        if c and c not in seen:
            seen.add(c)
            out.append(i)
    return out


def cell_ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each cell of hashes by its count.

    Cells at the level of chance are cut by count into ranks of about as many shingles; what
    stands above chance follows by its logarithm.
    """
    crowded = sketch.above_chance(counts, 16)
    by_count = np.bincount(counts[~crowded])
    below = np.cumsum(by_count * np.arange(len(by_count)))  # shingles in cells of at most each count
    level = np.append(0, below[:-1]) * _CHANCE_RANKS // (below[-1] + 1)
    ranks = np.ceil(np.log2(np.maximum(counts - counts.mean(), 2))) + _ABOVE
    ranks[~crowded] = level[counts[~crowded]]
    return np.minimum(ranks, (1 << _RANK_BITS) - 1).astype(np.uint8)


def bit_maps(sets: list[np.ndarray]) -> pa.Array:
    """Of each set a map of bits, by the last bits of its shingles: whether an odd number of them fall there.

    A map has the next power of two bits, 64 at least. Halves of a map, one flipped where
    the other is set, are the map of half the size.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    bits = np.array([max(64, 1 << (n - 1).bit_length()) if n else 0 for n in sizes.tolist()], np.int64)
    offsets = np.append(0, np.cumsum(bits))
    shingles = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    place = (shingles & (np.repeat(bits, sizes) - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(place + np.repeat(offsets[:-1], sizes), minlength=int(offsets[-1])) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array((offsets // 64).astype(np.int32)), pa.array(words))


def class_table(docs: DataFrame, k: int = WORDS) -> tuple[DataFrame, np.ndarray]:
    """doc_id, row, n_shingles, cls, bits for each row of ``docs``; and the rank of each cell of hashes.

    The ranks come from counts over all texts (copies within a task once). ``bits`` are the map
    of the row's set, null where the task has had the class before.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.empty()
        names = ["doc_id", "row", "n_shingles", "cls", "bits", "part", "counts"]
        ids, seen = None, set()
        for batch in batches:
            ids = batch.column(0).type
            for chunk in buffers.chunks(batch.column(2), CHUNK_BYTES):
                sets, classes = shingle_sets(chunk, k)
                new = _fresh(classes, seen)
                if new:
                    sketch.count(counts, np.concatenate([sets[i] for i in new]))
                n = len(chunk)
                at = np.full(n, -1)
                at[new] = np.arange(len(new))
                maps = bit_maps([sets[i] for i in new]).take(pa.array(at, mask=at < 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, n),
                        batch.column(1).slice(chunk.first, n),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array(classes),
                        maps,
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names,
                )
            seen.clear() if len(seen) > 1 << 20 else None
        if ids is not None:
            packed = sketch.packed(counts)
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, ids), *[pa.nulls(n, pa.int64())] * 3, pa.nulls(n, pa.list_(pa.int64())),
                 pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())],
                names,
            )

    both = written(
        docs.select("doc_id", F.xxhash64("doc_id", "text"), "text").mapInArrow(
            read, f"doc_id {kind}, row long, n_shingles long, cls long, bits array<long>, part int, counts binary"
        ),
        "classes",
    )
    counts = sketch.summed(both.where("part is not null"))
    return both.where("part is null").drop("part", "counts"), cell_ranks(counts)


def prefix_table(docs: DataFrame, ranks: np.ndarray, threshold: Fraction, k: int = WORDS) -> DataFrame:
    """token, cls, n, place, met: the prefix shingles of each class that other classes have there too.

    ``met`` are the classes of the token, or more than a pair bucket holds where the
    token is so frequent that its rows are dealt out by class as well.
    """
    packed = zlib.compress(ranks.tobytes())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, seen = np.frombuffer(zlib.decompress(packed), np.uint8), set()
        for batch in batches:
            for chunk in buffers.chunks(batch.column(0), CHUNK_BYTES):
                sets, classes = shingle_sets(chunk, k)
                new = _fresh(classes, seen)
                sizes = np.array([len(sets[i]) for i in new], np.int64)
                length = np.array([prefix_length(int(n), threshold) for n in sizes], np.int64)
                heads = [ordered(sets[i], ranks)[:p] for i, p in zip(new, length.tolist(), strict=True)]
                if not heads:
                    continue
                owner, place = buffers.within(length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(heads).view(np.int64)),
                        pa.array(classes[new][owner]),
                        pa.array(sizes[owner].astype(np.int32)),
                        pa.array(place.astype(np.int32)),
                    ],
                    ["token", "cls", "n", "place"],
                )
            seen.clear() if len(seen) > 1 << 20 else None

    tokens = docs.select("text").mapInArrow(read, "token long, cls long, n int, place int")
    rank = F.shiftrightunsigned("token", _HASH_BITS)
    shares = F.pow(F.lit(2), F.greatest(rank - _SALT_RANK, F.lit(0))).cast("long")
    tokens = tokens.withColumn("salt", F.when(rank > _SALT_RANK, F.pmod("cls", shares)).otherwise(0))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tokens.repartition(parts, "token", "salt").dropDuplicates(["token", "salt", "cls"])
    met = F.count(F.lit(1)).over(Window.partitionBy("token", "salt"))
    met = F.when(rank > _SALT_RANK, F.lit(PAIR_BUCKET + 1)).otherwise(met)
    return dealt.withColumn("met", met).where("met > 1").drop("salt")


def _required(threshold: Fraction, a: Column, b: Column) -> Column:
    """Whether ``shared`` reaches the threshold: shared / (a + b - shared) >= p / q, in whole numbers."""
    p, q = threshold.numerator, threshold.denominator
    return F.col("shared") * (p + q) >= p * (a + b)


def candidate_pairs(prefixes: DataFrame, threshold: Fraction) -> DataFrame:
    """a, b, n_a, n_b: pairs that share a prefix shingle and whose sizes and places allow a link.

    ``a`` is the smaller set, or of equal ones that of the smaller class.
    """
    p, q = threshold.numerator, threshold.denominator
    member = F.struct("n", "cls", "place")
    groups = prefixes.groupBy("token").agg(F.sort_array(F.collect_list(member)).alias("g"))

    def partners(x: Column, i: Column) -> Column:
        rest = F.filter(
            F.slice("g", i + 2, F.size("g")),  # sorted by size, so y is no smaller than x
            lambda y: (q * x["n"] >= p * y["n"])
            & ((p + q) * F.least(x["n"] - x["place"], y["n"] - y["place"]) >= p * (x["n"] + y["n"])),
        )
        return F.transform(
            rest,
            lambda y: F.struct(
                x["cls"].alias("a"), y["cls"].alias("b"), x["n"].alias("n_a"), y["n"].alias("n_b")
            ),
        )

    pairs = groups.select(F.explode(F.flatten(F.transform("g", partners))).alias("p"))
    return pairs.select("p.*").dropDuplicates(["a", "b"])


def _differing(x: Column, y: Column) -> Column:
    """In how many bits two maps differ, the longer one folded to the size of the other."""

    def folded(z: Column, other: Column) -> Column:
        half = (F.size(z) / 2).cast("int")
        halves = F.zip_with(F.slice(z, 1, half), F.slice(z, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(z) > F.size(other), halves).otherwise(z)

    bits = F.zip_with(folded(x, y), folded(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda total, b: total + b)


def likely_pairs(pairs: DataFrame, classes: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs that the maps of bits of their classes don't rule out.

    Each shingle that only one of two sets has changes one bit, so they have at least as many as
    bits differ. Sizes that allow a link are within a factor of two where the threshold is a
    half or more, so one fold will do; below it nothing is ruled out.
    """
    if threshold < Fraction(1, 2):
        return pairs
    maps = classes.where("bits is not null").groupBy("cls").agg(F.first("bits").alias("bits"))
    left = pairs.join(maps.select(F.col("cls").alias("a"), F.col("bits").alias("x")), "a")
    both = left.join(maps.select(F.col("cls").alias("b"), F.col("bits").alias("y")), "b")
    most = F.floor((F.col("n_a") + F.col("n_b") - _differing(F.col("x"), F.col("y"))) / 2)
    possible = both.withColumn("shared", most).where(_required(threshold, F.col("n_a"), F.col("n_b")))
    return possible.select("a", "b", "n_a", "n_b")


def _class_filter(classes: DataFrame) -> bytes:
    """A set of bits by the first bits of the classes, of a fixed size whatever their number."""
    bit = F.shiftrightunsigned("cls", 64 - _FILTER_BITS)
    words = classes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))).alias("bits")
    )
    bits = np.zeros(1 << (_FILTER_BITS - 6), np.int64)
    for row in words.collect():
        bits[row["word"]] = row["bits"]
    return zlib.compress(bits.tobytes())


def fragments(
    docs: DataFrame, classes: DataFrame, ranks: np.ndarray, first: bool | None, k: int = WORDS
) -> DataFrame:
    """cls, fragment, shingles of the given classes: the first fragment, the others, or (None) whole sets.

    Fragments without shingles are left out; a whole set is fragment 0. A few other
    classes may come too. Rows are partitioned by class and fragment.
    """
    packed, wanted = zlib.compress(ranks.tobytes()), _class_filter(classes)
    shift = _U(_HASH_BITS + (_CHANCE_RANKS // FRAGMENTS - 1).bit_length())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, seen = np.frombuffer(zlib.decompress(packed), np.uint8), set()
        bits = np.frombuffer(zlib.decompress(wanted), np.int64).view(np.uint64)
        for batch in batches:
            for chunk in buffers.chunks(batch.column(0), CHUNK_BYTES):
                sets, classes = shingle_sets(chunk, k)
                at = classes.view(np.uint64) >> _U(64 - _FILTER_BITS)
                asked = (bits[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)
                cls, fragment, parts = [], [], []
                for i in _fresh(np.where(asked > 0, classes, 0), seen):
                    x = ordered(sets[i], ranks)
                    if first is None:
                        cuts = [0, len(x)]
                    else:
                        cuts = np.searchsorted(np.minimum(x >> shift, _U(FRAGMENTS)), np.arange(FRAGMENTS + 2))
                    for f in range(len(cuts) - 1):
                        if cuts[f + 1] > cuts[f] and (first is None or first == (f == 0)):
                            cls.append(int(classes[i]))
                            fragment.append(f)
                            parts.append(x[cuts[f] : cuts[f + 1]])
                if parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cls, pa.int64()), pa.array(fragment, pa.int32()), _lists(parts)],
                        ["cls", "fragment", "shingles"],
                    )
            seen.clear() if len(seen) > 1 << 20 else None

    found = docs.select("text").mapInArrow(read, "cls long, fragment int, shingles array<long>")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "cls", "fragment").dropDuplicates(["cls", "fragment"])


def _overlaps(pairs: DataFrame, parts: DataFrame, which: list[int]) -> DataFrame:
    """Of each pair and fragment that both have: what they share there, and how much either has."""
    left = parts.select(F.col("cls").alias("a"), "fragment", F.col("shingles").alias("x"))
    right = parts.select(F.col("cls").alias("b"), "fragment", F.col("shingles").alias("y"))
    asked = pairs.select("a", "b", F.explode(F.array(*map(F.lit, which))).alias("fragment"))
    return asked.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("part"), F.size("x").alias("in_a"), F.size("y").alias("in_b")
    )


def verified(docs: DataFrame, pairs: DataFrame, ranks: np.ndarray, threshold: Fraction, k: int = WORDS) -> DataFrame:
    """a, b, shared of the pairs that are similar, by partial overlaps of fragments."""

    def both(df: DataFrame) -> DataFrame:
        return df.select(F.col("a").alias("cls")).union(df.select("b"))

    met = _overlaps(pairs, fragments(docs, both(pairs), ranks, True, k), [0])
    # what is outside the first fragment may all be shared
    known = pairs.join(met, ["a", "b"], "left").na.fill(0, ["part", "in_a", "in_b"])
    most = F.col("part") + F.least(F.col("n_a") - F.col("in_a"), F.col("n_b") - F.col("in_b"))
    possible = _required(threshold, F.col("n_a"), F.col("n_b"))
    left = known.withColumn("shared", most).where(possible).select("a", "b", "n_a", "n_b", "part")
    left = written(left, "left")
    rest = _overlaps(left, fragments(docs, both(left), ranks, False, k), list(range(1, FRAGMENTS + 1)))
    sums = rest.groupBy("a", "b").agg(F.sum("part").alias("more"))
    total = left.join(sums, ["a", "b"], "left").withColumn(
        "shared", F.col("part") + F.coalesce("more", F.lit(0))
    )
    return total.where(possible).select("a", "b", "shared")


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) of a matrix that suffice to connect the rows and columns it connects."""
    out, rows, columns = [], np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool)
    for root in np.flatnonzero(linked.any(axis=1)).tolist():
        if not rows[root]:
            continue
        rows[root], front = False, np.array([root])
        while len(front):
            reach = linked[front][:, columns]
            met = reach.any(axis=0)
            new = np.flatnonzero(columns)[met]
            out += zip(front[reach.argmax(axis=0)[met]].tolist(), new.tolist(), strict=True)
            columns[new] = False
            reach = linked[rows][:, new]
            met = reach.any(axis=1)
            front = np.flatnonzero(rows)[met]
            if len(new):
                out += zip(front.tolist(), new[reach.argmax(axis=1)[met]].tolist(), strict=True)
            rows[front] = False
    return out


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of sets, and all their shingles with the place of the set of each."""
    size = np.array([len(x) for x in sets], np.int64)
    return size, np.concatenate(sets), np.repeat(np.arange(len(sets)), size)


def _similar(left: list[np.ndarray], right: list[np.ndarray], p: int, q: int) -> np.ndarray:
    """Which sets of the left and of the right (rows and columns) are similar, band by band of rows.

    Besides the result, a band and a slice of shingles of either side are all that is held.
    """
    (n_left, x, row), (n_right, y, column) = _flat(left), _flat(right)
    both = np.intersect1d(x, y)  # only these add to an overlap
    keep = np.isin(y, both)
    y, column = np.searchsorted(both, y[keep]), column[keep]
    order = np.argsort(y, kind="stable")
    y, column = y[order], column[order]
    linked = np.zeros((len(left), len(right)), bool)
    bounds = np.append(0, np.cumsum(n_left))
    for top in range(0, len(left), BAND):
        end = min(top + BAND, len(left))
        a, r = x[bounds[top] : bounds[end]], row[bounds[top] : bounds[end]] - top
        keep = np.isin(a, both)
        a, r = np.searchsorted(both, a[keep]), r[keep]
        used = np.unique(a)  # the slices go over the shingles of this band
        a = np.searchsorted(used, a)
        order = np.argsort(a, kind="stable")
        a, r = a[order], r[order]
        keep = np.isin(y, used)
        b, c = np.searchsorted(used, y[keep]), column[keep]
        overlap = np.zeros((end - top, len(right)), np.float32)
        for low in range(0, len(used), SLICE):
            width = min(SLICE, len(used) - low)
            part = np.zeros((end - top, width), np.float32)
            other = np.zeros((len(right), width), np.float32)
            i, j = np.searchsorted(a, (low, low + width))
            part[r[i:j], a[i:j] - low] = 1
            i, j = np.searchsorted(b, (low, low + width))
            other[c[i:j], b[i:j] - low] = 1
            overlap += part @ other.T
        sums = n_left[top:end, None] + n_right[None, :]
        linked[top:end] = overlap.astype(np.int64) * (p + q) >= p * sums
    return linked


def _by_token(crowded: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of crowded tokens with what ``found`` has for their token.

    A token may have a third of all rows; they are spread over SALTS tasks, each with a copy
    of the token's one row, of which there are far fewer.
    """
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    copies = found.withColumn("salt", salt)
    salted = crowded.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["token", "salt"]).drop("salt")


def _blocks(crowded: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """token, cls, i, j, x: the classes of each token for each pair of blocks, i <= j; x is the own block.

    Sets of which one is smaller than the threshold's part of the other are never similar. So the
    classes of a token fall into bands of set size, each by that factor wider than the one
    before, and only blocks of the same band or of neighbouring bands meet. Blocks are
    numbered band by band.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    banded = crowded.withColumn("band", band)
    count = F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_CLASSES)
    per_band = banded.groupBy("token", "band").agg(F.ceil(count).cast("int").alias("blocks"))
    # A few dozen bands for each token, as they grow by a factor.
    listed = per_band.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("band", "blocks"))).alias("bands"))
    before = lambda limit: F.aggregate(
        F.filter("bands", lambda b: b["band"] < limit), F.lit(0), lambda total, b: total + b["blocks"]
    )
    placed = _by_token(banded, listed)
    mine = F.filter("bands", lambda b: b["band"] == F.col("band"))[0]["blocks"]
    low, high = before(F.col("band") - 1), before(F.col("band") + 2)
    return (
        placed.withColumn("x", before(F.col("band")) + F.pmod(F.xxhash64("cls", "token"), mine).cast("int"))
        .withColumn("y", F.explode(F.sequence(low, high - 1)))
        .select("token", "cls", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x")
    )


def block_links(
    docs: DataFrame, crowded: DataFrame, ranks: np.ndarray, threshold: Fraction, k: int = WORDS
) -> DataFrame:
    """a, b: links among the classes of crowded prefix buckets, enough to connect what is similar there.

    Shingles of one passage crowd the same classes. Each shingle is led by the smallest
    crowded shingle that any of its classes has, and classes meet under their leaders.
    The classes of a leader are dealt into blocks by set size and hash, so that a block is
    bounded in shingles and in classes; each pair of blocks whose sizes allow links is a
    group of its own, compared as matrices row band by row band and slice by slice of the
    global order.
    """
    p, q = threshold.numerator, threshold.denominator
    least = crowded.groupBy("cls").agg(F.min("token").alias("least"))
    leaders = crowded.join(least, "cls").groupBy("token").agg(F.min("least").alias("leader"))
    led = _by_token(crowded, leaders).select(F.col("leader").alias("token"), "cls", "n")
    crowded = led.dropDuplicates(["token", "cls"])
    crowded = written(crowded, "led")
    sets = fragments(docs, crowded.select("cls"), ranks, None, k).select("cls", "shingles")
    rows = _blocks(crowded, threshold).join(sets, "cls")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cls")
        left, right = (group[group["x"] == group[side].iloc[0]] for side in ("i", "j"))
        a, b = left["cls"].to_numpy(), right["cls"].to_numpy()
        found = []
        if len(a) and len(b):
            found = _forest(_similar(left["shingles"].to_list(), right["shingles"].to_list(), p, q))
        links = [(a[i], b[j]) for i, j in found if a[i] != b[j]]
        return pd.DataFrame({"a": [x for x, _ in links], "b": [y for _, y in links]}, dtype="int64")

    return rows.groupBy("token", "i", "j").applyInPandas(compare, "a long, b long")


def link_groups(docs: DataFrame, threshold: Fraction = THRESHOLD, k: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, root, row, one row per row of ``docs``.

    ``component_id`` is the smallest doc_id among the rows that links reach, the row
    itself included; ``class_id`` tells rows with equal sets, ``root`` components, and ``row`` is
    a hash of id and text. Rows without words,
    null and empty texts, have 0 shingles, no class and link with nothing; a text
    of fewer than ``k`` words is one shingle. Null ids never name a component unless
    it has no other. Repeated rows link with each other; an empty table gives an
    empty table.
    """
    classes, ranks = class_table(docs, k)
    rows = classes.drop("bits")
    prefixes = written(prefix_table(docs, ranks, threshold, k), "prefixes")
    pairs = written(candidate_pairs(prefixes.where(F.col("met") <= PAIR_BUCKET), threshold), "pairs")
    pairs = written(likely_pairs(pairs, classes, threshold), "likely")
    links = verified(docs, pairs, ranks, threshold, k).select("a", "b")
    crowded = prefixes.where(F.col("met") > PAIR_BUCKET)
    if not crowded.isEmpty():
        links = links.union(block_links(docs, crowded, ranks, threshold, k))
    roots = components(links).withColumnRenamed("node", "cls")
    # Names are found by class, so that the rows of a large class or group meet one small
    # table in a join of their own, whose large partitions Spark splits.
    least = rows.groupBy("cls").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    rooted = written(rooted, "rooted")
    names = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("least"))
    names = written(names, "names")
    named = rooted.drop("least").join(names, F.col("root") == F.col("of")).select("cls", "root", "least")
    alone = F.col("n_shingles") == 0
    return rows.join(written(named, "named"), "cls").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.when(~alone, F.col("cls")).alias("class_id"),
        F.when(~alone, F.col("root")).alias("root"),
        "row",
    )


def one_of_each(docs: DataFrame, threshold: Fraction = THRESHOLD, k: int = WORDS) -> DataFrame:
    """The rows of ``docs`` without all but one of each linked group.

    The smallest id stays; among rows of that id, or without ids, one by a hash.
    Rows without words all stay.
    """
    groups = written(link_groups(docs, threshold, k), "groups")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = groups.where("root is not null").groupBy("root").agg(F.min(first).alias("best"))
    kept = best.select(F.col("best.row").alias("__row"))
    named = docs.withColumn("__row", F.xxhash64("doc_id", "text")).withColumn(
        "__empty", ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    )
    empty = named.where("__empty").select(*docs.columns)
    rest = named.where("not __empty").dropDuplicates(["__row"])
    return rest.join(kept, "__row", "left_semi").select(*docs.columns).union(empty)
