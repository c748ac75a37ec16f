"""Texts of an Arrow batch as one array of bytes, and hashes over it.

Everything here works on a whole chunk of texts at once with numpy. A chunk holds
a megabyte, or one text if that is longer, so memory does not depend on how many
rows a batch has; a dozen arrays of eight bytes for each byte may live at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
#: Values of bytes when A to Z count as a to z, and others for a second hash.
_FOLDED = _VALUES[_UPPER]
_SECOND = (np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1))[_UPPER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Chunk:
    """Texts laid end to end: text i is ``data[bounds[i]:bounds[i + 1]]``; ``first`` is its row in the batch."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts (strings or binaries, null as empty) in chunks of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield Chunk(at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    known = _powers[base]
    if len(known) < n:
        known = np.full(max(n, 2 * len(known)), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        _powers[base] = known
    return known[:n]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, _INVERSE)


def prefix_sums(data: np.ndarray, folded: bool = False, second: bool = False) -> np.ndarray:
    """Sums from which the hash of any stretch of bytes follows; see ``stretch``.

    ``second`` gives sums for another hash, of folded bytes.
    """
    values = (_SECOND if second else _FOLDED if folded else _VALUES)[data]
    values *= powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums


def stretch(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches from ``starts`` to ``ends`` (exclusive), wherever they lie.

    For stretches that may overlap, of under 1,024 bytes: from there on, powers of one base
    let long patterns of two letters cancel out. ``own_hashes`` has no such limit.
    """
    return mix((sums[ends] - sums[starts]) * inverse_powers(len(sums))[starts] + (ends - starts).astype(np.uint64))


_ramps = [np.zeros(1, np.uint64)]


def _ramp(n: int) -> np.ndarray:
    """0, 1, 2, ... times an odd number, modulo 2 ** 64."""
    if len(_ramps[0]) < n:
        _ramps[0] = np.arange(max(n, 2 * len(_ramps[0])), dtype=np.uint64) * _U(_BASE)
    return _ramps[0][:n]


def own_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, folded: bool = True, second: bool = False) -> np.ndarray:
    """Hashes of stretches that follow one another without overlap.

    Each byte counts by a mixed function of itself and its place in its stretch, so unlike
    the powers of one base no pattern of two letters can cancel out. ``second`` gives an
    independent hash of folded bytes; both together are 128 bits.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(chunk.data)
    values, ramp = (_SECOND if second else _FOLDED if folded else _VALUES)[chunk.data], _ramp(n)
    values += ramp
    values[starts[0] :] -= np.repeat(ramp[starts], np.diff(np.append(starts, n)))  # by place in the stretch
    values ^= values >> _U(32)
    values *= _U(0xBF58476D1CE4E5B9)
    values ^= values >> _U(29)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))


def words(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between white space, and each text's first word (with a last bound)."""
    inside = ~_SPACE[chunk.data]
    edge = np.empty(len(inside), bool)
    if len(inside):
        edge[0] = inside[0]
        np.greater(inside[1:], inside[:-1], out=edge[1:])
        cut = chunk.bounds[:-1]
        cut = cut[cut < len(inside)]
        edge[cut] = inside[cut]
    starts = np.flatnonzero(edge)
    if len(inside):
        last = np.empty(len(inside), bool)
        last[-1] = inside[-1]
        np.greater(inside[:-1], inside[1:], out=last[:-1])
        cut = chunk.bounds[1:-1] - 1
        cut = cut[cut >= 0]
        last[cut] = inside[cut]
        ends = np.flatnonzero(last) + 1
    else:
        ends = starts
    return starts, ends, np.searchsorted(starts, chunk.bounds)


def lines(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line between line feeds: its text, its place there, its start and its end."""
    feeds = np.flatnonzero(chunk.data == 0x0A)
    before = np.searchsorted(feeds, chunk.bounds)
    text, place = within(np.diff(before) + 1)
    at = before[text] + place
    last = at == before[text + 1]
    padded = np.append(feeds, 0)
    starts = np.where(place == 0, chunk.bounds[text], padded[at - 1] + 1)
    return text, place, starts, np.where(last, chunk.bounds[text + 1], padded[at])


def stripped(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds without white space at both ends; empty stretches end where they start."""
    solid = np.flatnonzero(~_SPACE[chunk.data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = high > low
    padded = np.append(solid, 0)
    return np.where(some, padded[low], starts), np.where(some, padded[high - 1] + 1, starts)


def code_points(chunk: Chunk) -> np.ndarray:
    """How many code points begin before each byte."""
    sums = np.zeros(len(chunk.data) + 1, np.int64)
    np.cumsum((chunk.data & 0xC0) != 0x80, out=sums[1:])
    return sums


def word_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray, folded: bool = True) -> np.ndarray:
    return own_hashes(chunk, starts, ends, folded)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive values; the last k - 1 reach beyond the end and are left out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _U(_BASE)
        out += hashes[j : j + n]
    return mix(out + _U(k))


def within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes laid end to end: each element's group and place in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return group, np.arange(int(counts.sum())) - begin[group]
