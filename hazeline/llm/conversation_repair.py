"""Conversation structure repair: the cheapest edits by iterative-deepening A*.

A conversation is right when its role initials read ``(s?(ua)+)?`` and no row is blank,
repeated or, without a fine, truncated. Four states read that pattern; a search state is a
row and a state of the pattern. Depth-first search takes edits in ASCII order (Delete,
Insert, Keep, Rerole) under a cost bound, which grows to the least cost that exceeded it. A
state that fails is kept with the bound it failed under, raised to what its children have
shown, and not entered again with less; the table holds over all bounds of one goal. So the
first path that fits the least bound is the ASCII-least of the cheapest ones.

Rows that must go take no part in the search: they cost 2 each wherever they stand, and as
D comes before I, inserts follow them.

Work is dealt by sorted ranges of (conversation, turn, role, hash of text), after equal rows
were counted, so a conversation or a repeated row with a third of all rows is spread over
many tasks. A conversation within one range is searched as a whole, up to ``SEGMENT`` rows.
A longer one is cut: each piece is searched from each state to each state, the pieces of a
range are joined into one table of 4 x 5 costs, and the ranges of a conversation into its
path. Pieces end with an edit that takes a row, so no path of a piece begins another one's,
and comparing pieces one after the other compares whole audits.

Rows with equal turn go by role and then by the SHA-256 of their text. Null turns come first;
a null role or text is one space, and rows with a null id are one conversation. Texts are
moved by key and read once each; their length does not matter to the search. Further columns
are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hazeline.llm.store import written

#: Rows of a conversation that are searched at a time, without those that must go.
SEGMENT = 64

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Faults of a row; the first that holds, from the highest.
OK, CUT, REPEATED, BLANK = range(4)
#: States of the pattern: nothing yet, after a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: A fifth goal: the end of the conversation, with inserts after the last row.
END = 4
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_ALLOWED = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
_REMEMBERED = 4096

_SPACE = r"\x20\x09-\x0D"


# ---------------------------------------------------------------- rows and faults


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies after the agreed damage, by the CRC-32 of ``conv_id:turn``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = shown("text")
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(lot == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(lot == 1, F.lit("")).when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).cast("long").alias("copies"),
    ).where("copies > 0")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("conv_id").alias("conv"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("hash"), "text", "copies"
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality of columns, nulls being equal."""
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def faults(rows: DataFrame) -> DataFrame:
    """One row per distinct conv, turn, role and hash of text: copies, and the fault of the first copy."""
    light = _keyed(rows).select(
        "conv",
        "turn",
        "role",
        "hash",
        "copies",
        (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("cut"),
    )
    counted = light.groupBy("conv", "turn", "role", "hash").agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("cut").alias("cut")
    )
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = light.groupBy("conv", "role", "hash").agg(F.min(turn).alias("least"))
    first = first.select(*(F.col(c).alias(f"first_{c}") for c in ("conv", "role", "hash")), F.col("least.turn").alias("first_turn"), F.lit(True).alias("first"))
    same = F.lit(True)
    for name in ("conv", "turn", "role", "hash"):
        same = same & F.col(name).eqNullSafe(F.col(f"first_{name}"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), REPEATED).when(F.col("cut"), CUT).otherwise(OK)
    return counted.join(first, same, "left").select("conv", "turn", "role", "hash", "copies", fault.alias("fault"))


# ---------------------------------------------------------------- the search


class Search:
    """Edits of one piece: ``items`` are pairs of role initial and whether the row is truncated."""

    def __init__(self, items: tuple[tuple[str, bool], ...]):
        self.items, self.tables = items, {}
        least = [0]
        for initial, cut in reversed(items):
            keep = (0 if initial in ("", "s", "u", "a") else REROLE) + TRUNCATED * cut
            least.append(least[-1] + min(DELETE, keep))
        self.least = least[::-1]  # by row: what the rows from here cost at least, whatever the pattern

    def edits(self, row: int, state: int, goal: int) -> list[tuple[str, int, int, int]]:
        """Edit, cost, next row and next state, in ASCII order."""
        if row == len(self.items):
            return [("I", INSERT, row, _NEXT[state])] if goal == END else []
        initial, cut = self.items[row]
        fine = TRUNCATED * cut
        found = [("D", DELETE, row + 1, state), ("I", INSERT, row, _NEXT[state])]
        kept = state if initial == "" else _ALLOWED.get((initial, state))
        if kept is not None:
            found.append(("K", fine, row + 1, kept))
        found.append(("R", REROLE + fine, row + 1, _NEXT[state]))
        return found

    def reachable(self, entry: int, goal: int) -> bool:
        if goal in (USER, ASSISTANT):
            return entry == goal or bool(self.items)
        if goal == SYSTEM:
            return entry == SYSTEM or entry == START and any(initial == "s" for initial, _ in self.items)
        return goal == END or entry == START

    def done(self, row: int, state: int, goal: int) -> bool:
        return row == len(self.items) and (state == goal or goal == END and state in (START, ASSISTANT))

    def best(self, entry: int, goal: int) -> tuple[int, str] | None:
        """Cost and edits of the answer, or None where no edits lead there."""
        if not self.reachable(entry, goal):
            return None
        failed = self.tables.setdefault(goal, {})
        bound = failed.get((0, entry), self.least[0])
        while True:
            path = self._under(bound, entry, goal, failed)
            if path is not None:
                return bound, path
            bound = failed[0, entry]

    def _under(self, bound: int, entry: int, goal: int, failed: dict) -> str | None:
        """The first path within ``bound``; else ``failed`` tells by state what is needed at least."""
        least, path = self.least, []
        if self.done(0, entry, goal):
            return ""
        # A frame: row, state, what is left to spend, edits not yet tried, least need seen.
        stack = [[0, entry, bound, iter(self.edits(0, entry, goal)), 1 << 60]]
        while stack:
            frame = stack[-1]
            for edit, cost, row, state in frame[3]:
                if self.done(row, state, goal) and cost <= frame[2]:
                    return "".join([*path, edit])
                need = 0 if self.done(row, state, goal) else failed.get((row, state), least[row])
                if cost + need > frame[2]:
                    frame[4] = min(frame[4], cost + need)
                    continue
                path.append(edit)
                stack.append([row, state, frame[2] - cost, iter(self.edits(row, state, goal)), 1 << 60])
                break
            else:
                row, state, left, _, seen = stack.pop()
                failed[row, state] = max(seen, left + 1)
                if stack:
                    edit = path.pop()
                    above = stack[-1]
                    cost = above[2] - left
                    above[4] = min(above[4], cost + failed[row, state])
        return None


# ---------------------------------------------------------------- pieces of long conversations


def table_of(search: Search) -> tuple[list[int | None], list[int | None]]:
    """Costs from each state to each goal, and the order of audits among the goals of a state."""
    costs, ranks = [None] * 20, [None] * 20
    for entry in range(4):
        found = {goal: search.best(entry, goal) for goal in range(5)}
        for goal, answer in found.items():
            if answer:
                costs[entry * 5 + goal] = answer[0]
        goals = sorted((g for g in range(4) if found[g]), key=lambda g: found[g][1])
        for place, goal in enumerate(goals):
            ranks[entry * 5 + goal] = place
    return costs, ranks


def trace(units: list[tuple[list, list]], entry: int, goal: int) -> tuple[int, list[int], list[int]] | None:
    """Cost, states between and order of the best way through all units; None without a way."""
    need = [[None] * 4 for _ in units]
    for at in range(len(units) - 1, -1, -1):
        costs = units[at][0]
        for state in range(4):
            if at == len(units) - 1:
                need[at][state] = costs[state * 5 + goal]
            else:
                ways = [
                    costs[state * 5 + g] + need[at + 1][g]
                    for g in range(4)
                    if costs[state * 5 + g] is not None and need[at + 1][g] is not None
                ]
                need[at][state] = min(ways, default=None)
    if need[0][entry] is None:
        return None
    states, order = [entry], []
    for at, (costs, ranks) in enumerate(units[:-1]):
        state = states[-1]
        good = [
            (ranks[state * 5 + g], g)
            for g in range(4)
            if costs[state * 5 + g] is not None
            and need[at + 1][g] is not None
            and costs[state * 5 + g] + need[at + 1][g] == need[at][state]
        ]
        rank, chosen = min(good)
        states.append(chosen)
        order.append(rank)
    last = units[-1][1][states[-1] * 5 + goal]
    return need[0][entry], [*states, goal], [*order, -1 if last is None else last]


def joined(units: list[tuple[list, list]]) -> tuple[list[int | None], list[int | None]]:
    """Units one after the other as one unit."""
    costs, ranks = [None] * 20, [None] * 20
    for entry in range(4):
        found = {goal: trace(units, entry, goal) for goal in range(5)}
        for goal, way in found.items():
            if way:
                costs[entry * 5 + goal] = way[0]
        for place, goal in enumerate(sorted((g for g in range(4) if found[g]), key=lambda g: found[g][2])):
            ranks[entry * 5 + goal] = place
    return costs, ranks


def _segment_schema(conv: T.DataType) -> T.StructType:
    lists = {"turns": "bigint", "roles": "string", "hashes": "binary", "counts": "bigint", "faults": "int"}
    schema = T.StructType().add("conv", conv).add("part", "integer").add("no", "integer").add("open", "boolean")
    for name, kind in lists.items():
        schema = schema.add(name, T._parse_datatype_string(f"array<{kind}>"))
    return schema


def segments(rows: DataFrame) -> DataFrame:
    """Conversations as pieces of sorted rows; ``open`` ones may not be whole conversations."""
    order = ["conv", "turn", "role", "hash"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = _segment_schema(rows.schema["conv"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, out = TaskContext.get().partitionId(), 0, []
        conv, piece, searched, whole = None, [], 0, False

        def close(open_: bool) -> None:
            nonlocal no, piece, searched
            if piece:
                out.append([conv, part, no, open_, *([row[i] for row in piece] for i in range(5))])
                no += 1
            piece, searched = [], 0

        kinds = to_arrow_schema(schema)

        def batch_of(found: list) -> pa.RecordBatch:
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)], schema=kinds)

        seen = False
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if not seen:
                    conv, seen = row[0], True
                elif row[0] != conv:
                    close(not whole)
                    conv, whole = row[0], True
                elif searched >= SEGMENT or len(piece) >= 16 * SEGMENT:
                    close(True)
                    whole = False
                piece.append(row[1:])
                searched += row[5] <= CUT
            if out:
                yield batch_of(out)
                out = []
        close(True)
        if out:
            yield batch_of(out)

    return dealt.mapInArrow(cut, schema)


def _items(roles: list[str], row_faults: list[int]) -> tuple[tuple[str, bool], ...]:
    return tuple((role[:1], fault == CUT) for role, fault in zip(roles, row_faults, strict=True) if fault <= CUT)


class _Searches:
    """Searches by their items, as most conversations look alike; forgotten when they are many."""

    def __init__(self):
        self.known = {}

    def of(self, roles: list[str], row_faults: list[int]) -> Search:
        items = _items(roles, row_faults)
        if items not in self.known:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            self.known[items] = Search(items)
        return self.known[items]


_UNIT = "costs array<long>, ranks array<int>"


def ways(pieces: DataFrame) -> DataFrame:
    """part, no, entry and goal of each open piece."""
    kind = pieces.schema["conv"].dataType.simpleString()

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _Searches()
        for batch in batches:
            found = [
                table_of(searches.of(roles, row_faults))
                for roles, row_faults in zip(batch.column("roles").to_pylist(), batch.column("faults").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv", "part", "no")),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.int32())),
                ],
                ["conv", "part", "no", "costs", "ranks"],
            )

    units = written(
        pieces.where("open").select("conv", "part", "no", "roles", "faults").mapInArrow(tables, f"conv {kind}, part int, no int, {_UNIT}"),
        "repair-units",
    )

    def listed(frame: pd.DataFrame, by: str) -> tuple[pd.DataFrame, list]:
        frame = frame.sort_values(by)
        clean = lambda values: [None if v is None or v != v else int(v) for v in values]
        return frame, [(clean(c), clean(r)) for c, r in zip(frame["costs"], frame["ranks"], strict=True)]

    def join_range(frame: pd.DataFrame) -> pd.DataFrame:
        frame, found = listed(frame, "no")
        costs, ranks = joined(found)
        return frame.head(1)[["conv", "part"]].assign(costs=[costs], ranks=[ranks])

    def through_ranges(frame: pd.DataFrame) -> pd.DataFrame:
        frame, found = listed(frame, "part")
        states = trace(found, START, END)[1]
        return pd.DataFrame({"part": frame["part"].to_numpy(), "of": frame["conv"].to_numpy(), "entry": states[:-1], "goal": states[1:]})

    def through_pieces(frame: pd.DataFrame) -> pd.DataFrame:
        frame, found = listed(frame, "no")
        states = trace(found, int(frame["entry"].iloc[0]), int(frame["goal"].iloc[0]))[1]
        return pd.DataFrame({"part": frame["part"], "no": frame["no"], "entry": states[:-1], "goal": states[1:]})

    ranges = units.groupBy("conv", "part").applyInPandas(join_range, f"conv {kind}, part int, {_UNIT}")
    of_ranges = ranges.groupBy("conv").applyInPandas(through_ranges, f"part int, of {kind}, entry int, goal int")
    met = units.join(of_ranges, (units["part"] == of_ranges["part"]) & units["conv"].eqNullSafe(of_ranges["of"]))
    met = met.select("conv", units["part"], "no", "costs", "ranks", "entry", "goal")
    return met.groupBy("conv", "part").applyInPandas(through_pieces, "part int, no int, entry int, goal int")


_EDITED = (
    "part int, no int, audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, first_turn long, last_turn long, low long, high long, turns long, "
    "rows array<struct<place:int,turn:long,role:string,hash:binary,edit:string,new_role:string>>"
)


def edits(rows: DataFrame) -> DataFrame:
    """What becomes of each piece of a conversation: its audit, counts and remaining rows."""
    pieces = written(segments(rows), "repair-pieces")
    found = ways(pieces).withColumnsRenamed({"part": "of_part", "no": "of_no"})
    todo = pieces.join(
        found, (pieces["part"] == found["of_part"]) & (pieces["no"] == found["of_no"]), "left"
    ).drop("of_part", "of_no")
    kind = rows.schema["conv"].dataType.simpleString()
    schema = T._parse_datatype_string(f"conv {kind}, {_EDITED}")

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, kinds = _Searches(), to_arrow_schema(schema)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                entry = START if row["entry"] is None else row["entry"]
                goal = END if row["goal"] is None else row["goal"]
                cost, path = searches.of(row["roles"], row["faults"]).best(entry, goal)
                out.append(_edited(row, cost, path, entry))
            yield pa.RecordBatch.from_pylist(out, kinds)

    return todo.mapInArrow(edit, schema)


def _edited(piece: dict, cost: int, path: str, state: int) -> dict:
    """The result row of a piece, given the edits of the rows that were searched."""
    audit, kept, steps, place = [], [], iter(path), 0

    def put(edit: str, row: dict, new_role: str | None) -> None:
        nonlocal place
        kept.append(row | {"place": place, "edit": edit, "new_role": new_role})
        place += 1

    none = {"turn": None, "role": None, "hash": None}
    counts = [0] * 4
    for turn, role, text, copies, fault in zip(
        piece["turns"], piece["roles"], piece["hashes"], piece["counts"], piece["faults"], strict=True
    ):
        counts[fault] += 1
        if fault <= CUT:
            row = {"turn": turn, "role": role, "hash": text}
            while (step := next(steps)) == "I":
                state = _NEXT[state]
                audit.append("I")
                put("I", none, _NAMES[state])
            audit.append(step)
            if step == "K":
                state = state if role == "" else _ALLOWED[role[0], state]
                put("K", row, role)
            elif step == "R":
                state = _NEXT[state]
                put("R", row, _NAMES[state])
            copies -= 1
            counts[REPEATED] += copies
        else:
            counts[fault] += copies - 1
        audit.append("D" * copies)
        cost += DELETE * copies
    for step in steps:
        state = _NEXT[state]
        audit.append(step)
        put("I", none, _NAMES[state])
    roles, known = piece["roles"], [t for t in piece["turns"] if t is not None]
    legal = {"su", "ua", "au"}
    illegal = sum(a[:1] + b[:1] not in legal for a, b in zip(roles, roles[1:], strict=False))
    illegal += sum(n - 1 for r, n in zip(roles, piece["counts"], strict=True) if r[:1] * 2 not in legal)
    return {
        "conv": piece["conv"],
        "part": piece["part"],
        "no": piece["no"],
        "audit": "".join(audit),
        "cost": cost,
        "blank": counts[BLANK],
        "duplicate": counts[REPEATED],
        "truncated": counts[CUT],
        "illegal": illegal,
        "first_role": roles[0],
        "last_role": roles[-1],
        "first_turn": piece["turns"][0],
        "last_turn": piece["turns"][-1],
        "low": min(known, default=None),
        "high": max(known, default=None),
        "turns": len(set(known)),
        "rows": kept,
    }


# ---------------------------------------------------------------- results


def figures(edited: DataFrame) -> DataFrame:
    """One row per conversation with rows: gaps, counts of faults, cost and audit."""
    piece = F.struct("part", "no", "audit", "first_role", "last_role", "first_turn", "last_turn")
    met = edited.groupBy("conv").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost", "turns")),
        F.sum("illegal").alias("inner"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    pairs = F.arrays_zip(
        F.slice("pieces", 1, F.size("pieces") - 1).alias("a"), F.slice("pieces", 2, F.size("pieces")).alias("b")
    )
    initials = lambda p: F.concat(F.left(p["a"]["last_role"], F.lit(1)), F.left(p["b"]["first_role"], F.lit(1)))
    between = F.size(F.filter(pairs, lambda p: ~initials(p).isin("su", "ua", "au")))
    again = F.size(F.filter(pairs, lambda p: p["a"]["last_turn"] == p["b"]["first_turn"]))
    return met.select(
        "conv",
        F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns") + again, F.lit(0)).cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("inner") + between).cast("long").alias("illegal"),
        "cost",
        F.array_join(F.transform("pieces", lambda p: p["audit"]), "").alias("audit"),
    )


def repaired(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv, part, no and place (their order), turn, edit, role, text.

    ``rows`` are those that ``edited`` came from. Inserted rows have no turn and an empty text.
    """
    kept = edited.select("conv", "part", "no", F.explode("rows").alias("row")).select("conv", "part", "no", "row.*")
    texts = _keyed(rows).groupBy("conv", "turn", "role", "hash").agg(F.first("text").alias("text"))
    old = kept.where("edit <> 'I'")
    met = old.join(texts, _same(old, texts, "conv", "turn", "role", "hash")).select(
        *(old[c] for c in ("conv", "part", "no", "place", "turn", "edit")), old["new_role"].alias("role"), texts["text"]
    )
    new = kept.where("edit = 'I'").select(
        "conv", "part", "no", "place", "turn", "edit", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    return met.unionByName(new)


def digests(found: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its ``role:text`` lines, streamed in order: no conversation is held as a whole.

    A hash goes through its bytes one after the other, so one task reads one conversation.
    """
    order = ["conv", "part", "no", "place"]
    dealt = found.repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text")
    kind = found.schema["conv"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running = None, None
        for batch in batches:
            ids, hashes = [], []
            for at, role, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                at = at.as_py()
                line = f"{role.as_py()}:{text.as_py()}".encode()
                if running is not None and at == conv:
                    running.update(b"\n")
                else:
                    if running is not None:
                        ids.append(conv)
                        hashes.append(running.hexdigest())
                    conv, running = at, hashlib.sha256()
                running.update(line)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(hashes)], ["conv", "sha"])
            last = batch.column(0).type
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], last), pa.array([running.hexdigest()])], ["conv", "sha"])

    return dealt.mapInArrow(digest, f"conv {kind}, sha string")


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each id of ``conversations``, damaged as agreed and repaired: the columns of ``op11``'s result."""
    rows = damaged(conversations)
    edited = written(edits(faults(rows)), "repair-edits")
    counts, hashes = figures(edited), digests(repaired(rows, edited))
    ids = conversations.select("conv_id").distinct()
    met = ids.join(counts, ids["conv_id"].eqNullSafe(counts["conv"]), "left")
    met = met.join(hashes, met["conv_id"].eqNullSafe(hashes["conv"]), "left")
    zero = lambda c: F.coalesce(counts[c], F.lit(0)).cast("long").alias(c)
    return met.select(
        "conv_id",
        *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce(counts["audit"], F.lit("")).alias("audit"),
        F.coalesce(hashes["sha"], F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
