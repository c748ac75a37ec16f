"""Suffix arrays by induced sorting, with numpy, and common prefixes in text order.

Suffixes are smaller or larger than their next suffix; the leftmost of each run of
smaller ones split the text into stretches. The stretches are named by their order,
the names are sorted as a text of their own, and the order of all other suffixes is
induced from that in two passes over the bytes' buckets.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not, as nothing is smallest."""
    up = np.empty(len(text), np.int8)
    up[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    up[-1:] = -1
    known = np.flatnonzero(up)  # equal neighbours are as the first unequal one after them
    return np.repeat(up[known], np.diff(np.append(-1, known))) > 0


def _refine(rank: np.ndarray, rows: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order ``rows`` within their ranks by ``key``; returns those that still share a rank.

    A rank is the first place of its group among all, so finer ranks fit in between.
    """
    order = np.lexsort((key, rank[rows]))
    rows, key = rows[order], key[order]
    coarse = rank[rows]
    new = np.append(True, coarse[1:] != coarse[:-1])
    finer = new.copy()
    finer[1:] |= key[1:] != key[:-1]
    at = np.arange(len(rows))
    rank[rows] = coarse + np.maximum.accumulate(np.where(finer, at, 0)) - np.maximum.accumulate(np.where(new, at, 0))
    ends = np.append(finer[1:], True)
    return rows[~(finer & ends)]


def _eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros beyond the end."""
    padded = np.append(text, np.zeros(8, np.uint8))
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out <<= np.uint64(8)
        out |= padded[j : j + len(text)]
    return out


def _name(text: np.ndarray, words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ranks of the stretches between leftmost-smaller positions, both ends included.

    Where one stretch begins another, the shorter is larger, as it ends in a
    position smaller than its next where the longer has a larger one. So bytes after
    a stretch count as the largest value, which UTF-8 does not have.
    """
    length = np.diff(np.append(at, len(text) - 1)) + 1
    rank, rows = np.zeros(len(at), np.int64), np.arange(len(at))
    done = 0
    while len(rows):
        left = length[rows] - done
        key = words[at[rows] + done]
        spare = np.minimum(8 - np.minimum(left, 8), 7).astype(np.uint64) * np.uint64(8)
        last = rows == len(at) - 1  # the text's end is smallest
        key = np.where(last, key, key | ((np.uint64(1) << spare) - np.uint64(1)))
        rows = _refine(rank, rows, key)
        done += 8
        rows = rows[length[rows] > done]
    return rank


def _sorted_leftmost(text: np.ndarray, at: np.ndarray, depth: int | None) -> np.ndarray:
    """The leftmost-smaller positions in the order of their suffixes, to ``depth`` bytes at least."""
    rank = _name(text, _eight(text), at)
    order = np.argsort(rank, kind="stable")
    same = rank[order][1:] == rank[order][:-1]
    rows = order[np.append(same, False) | np.append(False, same)]
    step = 1
    while len(rows) and (depth is None or 2 * step < depth):  # a stretch has two bytes at least
        follow = np.append(rank, np.full(1, -1))
        rows = _refine(rank, rows, follow[np.minimum(rows + step, len(rank))])
        step *= 2
    return at[np.argsort(rank, kind="stable")]


class _Buckets:
    """Positions by their byte, appended in order."""

    def __init__(self, text: np.ndarray):
        self.text, self.lists = text, [[] for _ in range(256)]

    def add(self, positions: np.ndarray) -> None:
        if not len(positions):
            return
        byte = self.text[positions]
        order = np.argsort(byte, kind="stable")
        positions, byte = positions[order], byte[order]
        cuts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        for low, high in zip(cuts, np.append(cuts[1:], len(byte)), strict=True):
            self.lists[byte[low]].append(positions[low:high])

    def drain(self, byte: int) -> np.ndarray:
        found = self.lists[byte]
        self.lists[byte] = []
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """The positions of ``text`` (bytes) in the order of their suffixes.

    With ``depth`` the order holds for the first ``depth`` bytes at least, which
    saves work in texts with long repeats. The byte 255 must not occur.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    seeds = _Buckets(text)
    if len(leftmost):
        seeds.add(_sorted_leftmost(text, leftmost, depth))

    def before(rows: np.ndarray, kind: bool) -> np.ndarray:
        rows = rows[rows > 0] - 1
        return rows[small[rows] == kind]

    larger, induced = [], _Buckets(text)
    induced.add(np.array([n - 1]))
    for byte in range(256):
        parts, wave = [], induced.drain(byte)
        while len(wave):
            parts.append(wave)
            found = before(wave, False)
            induced.add(found[text[found] > byte])
            wave = found[text[found] == byte]
        larger.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        induced.add(before(seeds.drain(byte), False))
    out, induced = [], _Buckets(text)
    for byte in range(255, -1, -1):
        parts, wave = [], induced.drain(byte)
        while len(wave):
            parts.append(wave)
            found = before(wave, True)
            induced.add(found[text[found] < byte])
            wave = found[text[found] == byte]
        induced.add(before(larger[byte][::-1], True))
        if parts:
            out.append(np.concatenate(parts))
        out.append(larger[byte][::-1])
    return np.concatenate(out)[::-1]


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """By position: how many bytes, up to ``limit``, it shares with the position before it in ``order``.

    Positions that ``order`` leaves out, and its first, have 0.
    """
    shared = np.zeros(len(text), np.int64)
    here, there = order[1:], order[:-1]
    room = np.minimum(limit, len(text) - np.maximum(here, there))
    words = _eight(text)
    done = 0
    while len(here):
        a, b = words[here + done], words[there + done]
        differ = a ^ b
        same = np.full(len(here), 8)
        odd = differ != 0
        # the first differing byte, from the highest set bit
        same[odd] = 7 - np.floor(np.log2(differ[odd].astype(np.float64)) / 8).astype(np.int64)
        same[odd] = np.where((differ[odd] >> (np.uint64(8) * (7 - same[odd]).astype(np.uint64))) == 0, same[odd] + 1, same[odd])
        shared[here] = np.minimum(done + same, room)
        done += 8
        on = (same == 8) & (room > done)
        here, there, room = here[on], there[on], room[on]
    return shared
