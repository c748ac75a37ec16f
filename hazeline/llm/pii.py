"""Personal data: generators propose spans, boosted trees choose among them.

The base kinds (e-mail, IP address, card, phone) have exact patterns and checks,
and their spans always stay. Beside them, generators with high recall propose
looser spans: anything around an at sign, runs of digits with separators, dotted
numbers, long tokens. Each has features of its format and its surroundings. Proposals
that touch a base span are settled; on the others boosted trees are fitted, with weak labels
from evidence that is no feature: a word that announces such data right before
(``tel``, ``ssn``, ``account``), or for tokens an assignment to a name like a key. So the trees
learn the formats that come announced, and find them where nothing announces them. For each
kind a threshold is calibrated: the lowest score from which on proposals are right often
enough, on documents kept from the fit as on all. No least number of proposals turns a
kind on or off.

Places of a text's matches and spans are found in sorted walks whose time grows little
faster than their number, so a long log of numbers is no trouble.

Only built-in functions are used. Features are small whole numbers, so the fit
reads one row per combination, summed over all proposals of the corpus; their
number is bounded by the ranges in ``FEATURES``. The trees become one expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.store import written

#: The base patterns, in the order in which kinds are listed. They are
#: written so that no match is tried twice from inside a run of characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of the method's own kinds.
PROPOSALS = {
    "address": r"(?<![^\x20\x09-\x0D@<>|,;])[^\x20\x09-\x0D@<>|,;]++@[^\x20\x09-\x0D@<>|,;]++",
    "number": r"(?<![0-9A-Za-z])[+(]?[0-9][\x20().0-9-]{5,}[0-9]",
    "dotted": r"(?<![0-9.])[0-9]++(?:[.:][0-9]++){3,7}+",
    "secret": r"(?<![0-9A-Za-z_])[0-9A-Za-z_]{20,}+",
}
KINDS = (*BASE, *PROPOSALS)
#: Features and the number of values each can take.
FEATURES = {
    "kind": 4, "digits": 21, "letters": 8, "breaks": 4, "plus": 2,
    "dot": 2, "hex": 2, "alone": 2, "varied": 2, "separators": 8,
}
TREES, RATE = 30, 0.3
#: Share of right proposals that a threshold must reach; one document in so many is kept from the fit.
PRECISION, FOLDS = 0.95, 5

#: Words that announce personal data.
_CUE = r"(?i)(?<![a-z])(tel|phone|call|fax|mobile|cell|card|visa|e-?mail|contact|account|acct|ssn|social security|iban|passport)( (no|number|nr))?\W{1,4}$"
_ASSIGNED = r"(?i)(token|key|secret|passw(or)?d|auth|api)\W{0,2}\s?[=:]\s?[\x22']?$"
_BYTE = "^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _walk(n: Column, begin: dict[str, Column], step, kind: str) -> Column:
    """What ``step`` adds for 0 to n - 1, given the state so far; it returns the next state and an array.

    Results are gathered in blocks of about the root of n, as an array is copied whenever
    it grows.
    """
    none = F.array().cast(f"array<{kind}>")
    block = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))

    def state(of: Column, out: Column) -> Column:
        return F.struct(*[of[name].alias(name) for name in begin], out.alias("out"))

    def whole_block(before: Column, b: Column) -> Column:
        def one(at: Column, i: Column) -> Column:
            following, added = step(at, i)
            fields = [following[name].alias(name) for name in begin]
            return F.struct(*fields, F.concat(at["out"], added).alias("out"))

        last = F.least((b + 1) * block, n) - 1
        found = F.aggregate(F.sequence(b * block, last), state(before, none), one)
        return _let(found, lambda f: state(f, F.concat(before["out"], f["out"])))

    start = F.struct(*[value.alias(name) for name, value in begin.items()], none.alias("out"))
    blocks = F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1)
    return F.when(n <= 0, none).otherwise(F.aggregate(blocks, start, whole_block, lambda f: f["out"]))


_MATCH = "struct<start:int,end:int,body:string,left:string,right:string>"


def _matches(text: Column, pattern: str) -> Column:
    """Structs of start, end, body, left, right for each match, in code points.

    Places follow from the lengths of the matches and of the pieces between them,
    as both come from the same run of the pattern over the text.
    """

    def placed(found: Column) -> Column:
        def walk(pieces: Column) -> Column:
            def step(state: Column, i: Column):
                piece, body = F.get(pieces, i), F.get(found, i)
                start = state["at"] + F.length(piece)
                end = start + F.length(body)
                match = F.struct(
                    start.alias("start"),
                    end.alias("end"),
                    body.alias("body"),
                    F.right(piece, F.lit(24)).alias("left"),
                    F.substring(F.get(pieces, i + 1), 1, 1).alias("right"),
                )
                return {"at": end}, F.array(match)

            return _walk(F.size(found), {"at": F.lit(0)}, step, _MATCH)

        none = F.array().cast(f"array<{_MATCH}>")
        return F.when(F.size(found) == 0, none).otherwise(_let(F.split(text, pattern, -1), walk))

    return _let(F.regexp_extract_all(text, F.lit(pattern), 0), placed)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, body: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(body, r"\."), lambda part: part.rlike(_BYTE))
    if kind == "card":
        return _let(_digits(body), lambda d: F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(body)).between(10, 15)
    return F.lit(True)


def _features(number: int, m: Column) -> dict[str, Column]:
    body = m["body"]

    def count(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern))

    edge = r"^[\x20\x09-\x0D,.;:\x22'()\[\]|]?$"
    return {
        "kind": F.lit(number),
        "digits": F.least(count("[0-9]"), F.lit(20)),
        "letters": F.least(F.floor(F.log2(count("[A-Za-z]") + 1)).cast("int"), F.lit(7)),
        "breaks": F.least(count(r"[^0-9A-Za-z]+"), F.lit(3)),
        "plus": body.startswith("+").cast("int"),
        "dot": body.rlike(r"@[^.]+\.[A-Za-z]{2,}").cast("int"),
        "hex": body.rlike("^[0-9a-f]+$").cast("int"),
        "alone": (F.right(m["left"], F.lit(1)).rlike(edge) & m["right"].rlike(edge)).cast("int"),
        "varied": (F.size(F.array_distinct(F.split(_digits(body), ""))) > 4).cast("int"),
        # Which of hyphen, dot or colon, and bracket stand inside.
        "separators": body.contains("-").cast("int")
        + 2 * body.rlike("[.:]").cast("int")
        + 4 * body.rlike("[()]").cast("int"),
    }


def _base_spans(rank: int, kind: str) -> Column:
    def span(m: Column) -> Column:
        return F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")
        )

    good = F.filter(_matches(F.col("text"), BASE[kind]), lambda m: _valid(kind, m["body"]))
    return F.transform(good, span)


_X = "struct<" + ",".join(f"{name}:int" for name in FEATURES) + ">"
_SPAN = "struct<start:int,rank:int,kind:string,end:int>"
_PROPOSAL = f"struct<start:int,rank:int,kind:string,end:int,x:{_X},label:int>"


def _proposed(number: int, kind: str) -> Column:
    def described(m: Column) -> Column:
        right = m["left"].rlike(_ASSIGNED if kind == "secret" else _CUE)
        return F.struct(
            m["start"].alias("start"),
            F.lit(len(BASE) + number).alias("rank"),
            F.lit(kind).alias("kind"),
            m["end"].alias("end"),
            F.struct(*[x.cast("int").alias(f) for f, x in _features(number, m).items()]).alias("x"),
            right.cast("int").alias("label"),
        )

    found = _matches(F.col("text"), PROPOSALS[kind])
    if kind == "secret":  # words alone are no secrets
        found = F.filter(found, lambda m: m["body"].rlike("[0-9]"))
    if kind == "number":
        found = F.filter(found, lambda m: F.length(_digits(m["body"])) >= 7)
    return F.transform(found, described)


def _apart(base: Column, proposals: Column) -> Column:
    """The proposals that touch no base span.

    All spans are sorted by start. Going up, the greatest end of a base span so far tells
    whether one before reaches into a proposal; going down, the least start of one so far
    whether one begins inside it.
    """

    def sweep(spans: Column, begin: int, note, free) -> Column:
        def step(state: Column, i: Column):
            span = F.get(spans, i)
            is_base = span["rank"] < len(BASE)
            following = F.when(is_base, note(state["edge"], span)).otherwise(state["edge"])
            none = F.array().cast(f"array<{_PROPOSAL}>")
            return {"edge": following}, F.when(is_base | free(state["edge"], span), F.array(span)).otherwise(none)

        return _walk(F.size(spans), {"edge": F.lit(begin)}, step, _PROPOSAL)

    def down(spans: Column) -> Column:
        least = lambda edge, span: F.least(edge, span["start"])
        kept = sweep(spans, 2**31 - 1, least, lambda edge, span: edge >= span["end"])
        return F.filter(kept, lambda span: span["rank"] >= len(BASE))

    def up(spans: Column) -> Column:
        most = lambda edge, span: F.greatest(edge, span["end"])
        return _let(F.reverse(sweep(spans, -1, most, lambda edge, span: edge <= span["start"])), down)

    empty = F.lit(None).cast(_X), F.lit(None).cast("int")
    as_proposals = F.transform(
        base, lambda b: F.struct(b["start"], b["rank"], b["kind"], b["end"], empty[0].alias("x"), empty[1].alias("label")).cast(_PROPOSAL)
    )
    both = _let(F.sort_array(F.concat(as_proposals, proposals.cast(f"array<{_PROPOSAL}>"))), up)
    return F.when(F.size(base) == 0, F.sort_array(proposals.cast(f"array<{_PROPOSAL}>"))).otherwise(both)


def propose(docs: DataFrame) -> DataFrame:
    """doc_id, fold, base and proposals of each whole text; null counts as empty.

    ``base`` holds kind, start, end of the checked base spans; ``proposals`` the generators'
    spans that touch none of them, with features and weak label.
    """
    text = F.coalesce("text", F.lit(""))
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = docs.select("doc_id", fold.alias("fold"), text.alias("text"))
    checked = F.concat(*[_base_spans(rank, kind) for rank, kind in enumerate(BASE)])
    proposed = F.concat(*[_proposed(number, kind) for number, kind in enumerate(PROPOSALS)])
    found = _let(
        F.struct(F.sort_array(checked).alias("base"), proposed.alias("proposed")),
        lambda f: F.struct(f["base"].alias("base"), _apart(f["base"], f["proposed"]).alias("proposals")),
    )
    return rows.select("doc_id", "fold", found.alias("found")).select("doc_id", "fold", "found.base", "found.proposals")


def fit_trees(x: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[float, list[tuple]]:
    """Boost depth-two trees on rows that stand for ``n`` proposals of which ``good`` are right.

    A tree is (feature, cut, left, right) where a side is (feature, cut, value, value).
    """
    share = (good.sum() + 1) / (n.sum() + 2)
    prior = float(np.log(share / (1 - share)))
    total, trees = np.full(len(n), prior), []
    for _ in range(TREES if len(n) else 0):
        p = 1 / (1 + np.exp(-total))
        grad, hess = good - n * p, n * p * (1 - p)

        def best(rows: np.ndarray, grad=grad, hess=hess) -> tuple[int, int]:
            top, where = -1.0, (0, 0)
            for f, values in enumerate(FEATURES.values()):
                g = np.bincount(x[rows, f], grad[rows], values).cumsum()
                h = np.bincount(x[rows, f], hess[rows], values).cumsum()
                gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1)
                cut = int(gain[:-1].argmax())
                if gain[cut] > top + 1e-9:
                    top, where = float(gain[cut]), (f, cut)
            return where

        def value(rows: np.ndarray, grad=grad, hess=hess) -> float:
            return round(float(RATE * grad[rows].sum() / (hess[rows].sum() + 1)), 9)

        everything = np.ones(len(n), bool)
        f, cut = best(everything)
        sides = []
        for part in (x[:, f] <= cut, x[:, f] > cut):
            g, at = best(part)
            low, high = part & (x[:, g] <= at), part & (x[:, g] > at)
            sides.append((g, at, value(low), value(high)))
            total += low * sides[-1][2] + high * sides[-1][3]
        trees.append((f, cut, *sides))
    return prior, trees


def score_cells(x: np.ndarray, prior: float, trees: list[tuple]) -> np.ndarray:
    total = np.full(len(x), prior)
    for f, cut, low, high in trees:
        for side, rows in ((low, x[:, f] <= cut), (high, x[:, f] > cut)):
            total += rows * np.where(x[:, side[0]] <= side[1], side[2], side[3])
    return total


def score_column(x: Column, prior: float, trees: list[tuple]) -> Column:
    """The trees as one expression over a struct of features; the logit of being right."""
    names = list(FEATURES)

    def leaf(side: tuple) -> Column:
        return F.when(x[names[side[0]]] <= side[1], side[2]).otherwise(side[3])

    total = F.lit(prior)
    for f, cut, low, high in trees:
        total = total + F.when(x[names[f]] <= cut, leaf(low)).otherwise(leaf(high))
    return total


def thresholds(score: np.ndarray, kind: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
    """For each kind the lowest score from which on proposals are right often enough; else infinity.

    ``counts`` are proposals and right ones by cell, of the documents kept from the fit and of
    all. A set without a proposal that high has no say.
    """
    cuts = []
    for k in range(len(PROPOSALS)):
        at = np.flatnonzero(kind == k)
        at = at[np.argsort(-score[at], kind="stable")]
        fine = np.append(score[at][1:] < score[at][:-1], True)[: len(at)]
        for n, good in counts:
            fine &= good[at].cumsum() >= PRECISION * n[at].cumsum()
        fine &= counts[-1][1][at].cumsum() > 0
        found = np.flatnonzero(fine)
        cuts.append(float(score[at][found[-1]]) - 1e-6 if len(found) else float("inf"))
    return cuts


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, base, spans (kind, start, end and rank, by start, then kind).

    ``base`` are the checked spans of the base kinds, ``spans`` these and the proposals
    chosen by the trees. Where chosen proposals overlap, the one that starts first
    stays, the longer of two that start together. Null and empty texts have no spans;
    repeated rows get equal spans; an empty table gives an empty table. A text of any length
    is one unit of work.
    """
    rows = written(propose(docs), "proposals")
    names = list(FEATURES)
    kept_out = F.col("fold") == 0
    cells = (
        rows.select("fold", F.explode("proposals").alias("p"))
        .groupBy(*[F.col(f"p.x.{f}").alias(f) for f in names])
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("p.label").alias("good"),
            F.count_if(kept_out).alias("n_out"),
            F.sum(F.when(kept_out, F.col("p.label")).otherwise(0)).alias("good_out"),
        )
        .orderBy(*names)
        .collect()
    )
    x = np.array([[c[f] for f in names] for c in cells], int).reshape(len(cells), len(names))
    n, good, n_out, good_out = (np.array([c[k] for c in cells], float) for k in ("n", "good", "n_out", "good_out"))
    fitted = n > n_out
    prior, trees = fit_trees(x[fitted], (n - n_out)[fitted], (good - good_out)[fitted])
    cuts = thresholds(score_cells(x, prior, trees), x[:, 0], [(n_out, good_out), (n, good)])

    def enough(p: Column) -> Column:
        lowest = F.element_at(F.array(*map(F.lit, cuts)), p["x"]["kind"] + 1)
        return score_column(p["x"], prior, trees) >= lowest

    chosen = F.transform(
        F.filter("proposals", enough),
        lambda p: F.struct(p["start"].alias("start"), (-p["end"]).alias("back"), p["rank"].alias("rank"), p["kind"].alias("kind")),
    )

    def without_overlaps(sorted_: Column) -> Column:
        def step(state: Column, i: Column):
            p = F.get(sorted_, i)
            span = F.struct(p["start"].alias("start"), p["rank"].alias("rank"), p["kind"].alias("kind"), (-p["back"]).alias("end"))
            free = p["start"] >= state["end"]
            none = F.array().cast(f"array<{_SPAN}>")
            return {"end": F.when(free, -p["back"]).otherwise(state["end"])}, F.when(free, F.array(span)).otherwise(none)

        return _walk(F.size(sorted_), {"end": F.lit(0)}, step, _SPAN)

    added = _let(F.sort_array(chosen), without_overlaps)
    base = F.col("base").cast(f"array<{_SPAN}>")
    return rows.select("doc_id", base.alias("base"), F.sort_array(F.concat(base, added)).alias("spans"))
