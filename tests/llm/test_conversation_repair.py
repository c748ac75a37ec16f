"""Repair of conversations against dynamic programming."""

from __future__ import annotations

import itertools
import random

import brute
import pytest
from conftest import SMALL

from hazeline.llm import conversation_repair as cr
from hazeline.llm.queries import REGISTRY

COLUMNS = "conv_id long, turn long, role string, text string"
ROLES = [None, "", "user", "user", "assistant", "assistant", "system", "tool", "unknown"]


def odd_rows():
    """Nulls, ties, repeated rows, long conversations and texts, roles outside the pattern."""
    rng = random.Random(3)
    texts = [None, "", "a.", "b!", "no end", " \t\n", "é?  ", "x" * 50_000 + "."]
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.choice([1, 2, 3, 9, 30, 150])):
            text = rng.choice([*texts, f"x{rng.random()}. ", f"y{rng.random()}", f"z{rng.random()} ?"])
            row = (conv, rng.choice([None, turn, turn, turn * 2]), rng.choice(ROLES), text)
            rows += [row] * rng.choice([1, 1, 1, 2, 5])
    rows += [(700, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(2000)]
    rows += [(800, 3, "user", "the same.")] * 3000
    rows += [(900, t, rng.choice(["user", "assistant", "system", "odd"]), f"t {t}" + "." * (t % 3)) for t in range(400)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], f"{COLUMNS}, part string, audit int")
    return rows, frame.repartition(5).cache()


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("segment", [256, 64, 17, 2])
def test_odd_rows(odd, monkeypatch, segment):
    """Pieces of any length give the whole conversation's answer."""
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows, frame = odd
    assert ordered(cr.repair(frame).collect()) == ordered(brute.repair_conversations(rows))


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = REGISTRY["op11_conversation_repair"](spark, SMALL)
    assert got.columns[0] == "conv_id"
    assert ordered(got.collect()) == ordered(brute.repair_conversations(rows))


def test_no_rows(spark):
    assert cr.repair(spark.createDataFrame([], COLUMNS)).collect() == []


def test_repaired_rows_read_as_the_pattern(odd):
    rows, frame = odd
    damaged = cr.damaged(frame)
    edited = cr.edits(cr.faults(damaged)).cache()
    found = {}
    for r in cr.repaired(damaged, edited).orderBy("conv", "part", "no", "place").collect():
        found.setdefault(r["conv"], []).append(r)
    for kept in found.values():
        initials = "".join(r["role"][:1] for r in kept)
        assert initials.removeprefix("s") == "ua" * (len(initials.removeprefix("s")) // 2)
        assert all((r["edit"] == "I") == (r["turn"] is None and r["text"] == "") or r["turn"] is None for r in kept)
    assert sum(len(kept) for kept in found.values()) == edited.selectExpr("sum(size(rows))").first()[0]


def edit_strings(items, goal, entry):
    """All edit strings of up to two inserts a place, with their costs."""
    steps = [p + (e,) for p in [(), ("I",), ("I", "I")] for e in "DKR"]
    tails = [(), ("I",), ("I", "I")] if goal == cr.END else [()]
    for choice in itertools.product(*[steps] * len(items)):
        for tail in tails:
            edits, search, state, at, cost = [*itertools.chain(*choice), *tail], cr.Search(items), entry, 0, 0
            for edit in edits:
                found = [e for e in search.edits(at, state, goal) if e[0] == edit]
                if not found:
                    break
                cost, at, state = cost + found[0][1], found[0][2], found[0][3]
            else:
                if search.done(at, state, goal):
                    yield cost, "".join(edits)


@pytest.mark.parametrize("entry", range(4))
@pytest.mark.parametrize("goal", range(5))
def test_search_gives_the_least_of_all_edit_strings(entry, goal):
    rng = random.Random(10 * entry + goal)
    for n in (1, 1, 2, 2, 3, 3):
        items = tuple((rng.choice(["s", "u", "a", "t", ""]), rng.random() < 0.3) for _ in range(n))
        assert cr.Search(items).best(entry, goal) == min(edit_strings(items, goal, entry), default=None)


def test_bounds_are_not_searched_twice():
    """The table keeps what failed: no state is entered more often than its need grows."""
    search = cr.Search((("u", False),) * 60)
    entered = []
    plain = cr.Search.edits
    search.edits = lambda *a: entered.append(a) or plain(search, *a)
    cost, _ = search.best(cr.START, cr.END)
    assert len(entered) <= 61 * 4 * (cost + 1)
