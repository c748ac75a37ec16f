"""Plain versions of the operators' results, by the shortest way, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def link_groups(docs):
    sets, ids = [], [d for d, _ in docs]
    for _, text in docs:
        words = SPACED.findall((text or "").translate(LOWER))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}
        sets.append(grams if words else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_gram = defaultdict(list)
    for i, grams in enumerate(sets):
        met = Counter(j for g in grams for j in by_gram[g])
        for j, shared in met.items():
            if 100 * shared >= 80 * (len(grams) + len(sets[j]) - shared):
                root[find(i)] = find(j)
        for g in grams:
            by_gram[g].append(i)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, d in enumerate(ids)]


def decontaminate(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall((text or "").translate(LOWER))
        if words:
            for i in range(max(1, len(words) - 9)):
                windows[tuple(words[i : i + 10])].add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        words = PLAIN.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                items_ = windows.get(tuple(words[i : i + n]))
                if items_:
                    hit.update(range(i, i + n))
                    found |= items_
        names = sorted(map(str, found))
        out.append((doc, len(words), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return out


def line_dedup(docs):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(LOWER)

    last = 1 << 62
    where = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                where[key(line)].add(last if doc is None else doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        me = last if doc is None else doc
        kept = [x for x in lines if len(key(x)) < 10 or min(where[key(x)]) == me]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def suffix_dedup(docs, length=100):
    last = 1 << 62
    order = sorted(range(len(docs)), key=lambda i: last if docs[i][0] is None else docs[i][0])
    first, out = {}, {}
    for i in order:
        doc = docs[i][0]
        data = (docs[i][1] or "").encode()
        for p in range(len(data) - length + 1):
            w = hash(data[p : p + length]), data[p : p + 8]
            first[w] = min(first.get(w, (last + 1, 0)), (last if doc is None else doc, p))
    for i in order:
        doc = docs[i][0]
        data = (docs[i][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[hash(data[p : p + length]), data[p : p + 8]] < (last if doc is None else doc, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (doc, len(data), sum(gone), runs, sha(kept))
    return [out[i] for i in range(len(docs))]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, body):
    digits = [int(c) for c in body if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in body.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def pii_base(docs):
    out = []
    for doc, text in docs:
        found, counts = [], []
        for rank, (kind, pattern) in enumerate(BASE.items()):
            good = [m for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]
            counts.append(len(good))
            found += [(m.start(), rank, kind, m.end()) for m in good]
        base = ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))
        out.append((doc, *counts, sha(base)))
    return out


PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


def license_base(docs):
    out = []
    for doc, text in docs:
        words = PLAIN.findall((text or "").translate(LOWER))
        places = [
            (i, label)
            for i in range(len(words))
            for phrase, label in PHRASES.items()
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        labels = ",".join(sorted({x for _, x in places}))
        out.append((doc, len(words), len(places), min(starts, default=None), max(starts, default=None), labels))
    return out


def rules_base(docs):
    out = []
    for doc, text in docs:
        text = text or ""
        words = SPACED.findall(text)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        again = {i + j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        out.append(
            (
                doc,
                len(words),
                sum(map(len, words)),
                len(re.findall(r"[#*$%&|<>]", text)),
                len(lines) - len(set(lines)),
                len(again),
                len(words) < 50 or 100 * len(again) > 50 * len(words),
            )
        )
    return out


def mix_targets(docs, repeats=3):
    """Source to (size, target), by sharing the excess until none is above."""
    size = defaultdict(int)
    for _, source, text in docs:
        size[source] += len(SPACED.findall(text or ""))
    names = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    full, rest = set(), float(sum(size.values()))
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > repeats * size[s]]
        if not over:
            break
        full |= set(over)
        rest = sum(size.values()) - sum(repeats * size[s] for s in full)
        if len(full) == len(names):
            break
    return {s: (size[s], float(repeats * size[s]) if s in full else share[s]) for s in names}


BLANK = " \t\n\v\f\r"


def damaged_conversations(rows):
    """Rows after damage, by conversation and in order; conversations without rows too."""
    shown = lambda v: " " if v is None else str(v)
    convs = {}
    for conv, turn, role, text in rows:
        found = convs.setdefault(conv, [])
        lot = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = "user" if lot == 4 else shown(role), shown(text)
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        found += [(turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    for found in convs.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    return convs


def repair_conversations(rows):
    """By dynamic programming: the best edits that end in each state of the pattern."""
    after, names = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    out = []
    for conv, found in damaged_conversations(rows).items():
        seen, faults = set(), []
        for _, role, text in found:
            bare = text.strip(BLANK)
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))

        def relax(best, state, way):
            if state not in best or way[:2] < best[state][:2]:
                best[state] = way

        def inserts(best):
            best = dict(best)
            for _ in range(2):
                for state, (cost, audit, lines) in list(best.items()):
                    into = after[state]
                    relax(best, into, (cost + 5, audit + "I", (*lines, f"{names[into]}:")))
            return best

        best = {"": (0, "", ())}
        for (_, role, text), fault in zip(found, faults, strict=True):
            then = {}
            for state, (cost, audit, lines) in best.items():
                relax(then, state, (cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                fine = 5 * (fault == "truncated")
                for state, (cost, audit, lines) in inserts(best).items():
                    if role == "" or (state, role[0]) in legal:
                        relax(then, role[:1] or state, (cost + fine, audit + "K", (*lines, f"{role}:{text}")))
                    into = after[state]
                    relax(then, into, (cost + 1 + fine, audit + "R", (*lines, f"{names[into]}:{text}")))
            best = then
        cost, audit, lines = min((way for state, way in inserts(best).items() if state in ("", "a")), key=lambda w: w[:2])
        turns = [t for t, _, _ in found if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, sha("\n".join(lines))))
    return out


def whitened(vectors, components=8):
    """n, deviation, the covariance's eigenvalues and each row's coordinates, from whole numbers."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[math.floor(1024 * c) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in kept]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    apart = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    square = [[sum(r[i] * r[j] for r in apart) / n**3 for j in range(width)] for i in range(width)]
    values, axes = np.linalg.eigh(np.array(square))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    points = (np.array(apart, float) / n) @ axes / np.sqrt(values)
    return [i for i, _ in kept], n, [sum(c * c for c in row) for row in apart], values / np.trace(square), points
