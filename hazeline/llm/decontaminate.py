"""Benchmark decontamination through a positional inverted index.

Windows of consecutive benchmark words are searched in the training texts. Terms
are counted over the whole corpus first. The postings (row, place) of each window's
rarest terms are stored. Those of the rarest one, shifted back by its offset in the
window, are the places where the window may begin; they are intersected with the
postings of the next rarest, shifted alike, and so on. What remains is checked word
by word. Places where the rare terms come together within a little slack, but not
exactly, are proximity matches.

Only built-in functions are used. Lists of benchmark terms and windows are
broadcast after their rows are counted; longer lists are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.store import written

WINDOW = 10
#: So many of a window's rarest terms are intersected.
RAREST = 3
#: Proximity matches may spread over so many words more than the window.
SLACK = 5
#: Longer lists of terms or windows are not broadcast.
BROADCAST_ROWS = 500_000
#: And so many bytes, as JSON.
BROADCAST_BYTES = 64 * 1024 * 1024

_WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def exact_words(text: Column) -> Column:
    """The words of a text with A to Z lowered; none for null."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(folded, F.lit(_WORD), 0)


def _lowered(text: Column) -> Column:
    """Lower case letter by letter; ``lower`` alone looks at the neighbours of a capital sigma."""
    return F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))


def loose_words(text: Column) -> Column:
    """The same words at the same places, lowered by the full alphabet.

    It is much faster. Words equal by ``exact_words`` are equal here too, so a search
    on these misses nothing, and its few finds are checked on the exact words.
    """
    return F.regexp_extract_all(_lowered(F.coalesce(text, F.lit(""))), F.lit(_WORD), 0)


def _bounded(df: DataFrame, limit: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast if the rows are few and, as text, small; else as it is."""
    length = F.octet_length(F.to_json(F.struct("*")))
    found = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if found["n"] <= limit and found["size"] <= size else df


def benchmark_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """window, words, items: each distinct window with the ids of the items that have it.

    An item of fewer words than ``size``, but not none, is one window.
    """
    rows = items.select("item_id", exact_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    cut = rows.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("words")
    )
    return (
        cut.withColumn("window", F.array_join("words", " "))
        .groupBy("window")
        .agg(F.first("words").alias("words"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )


def _tokens(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), loose_words(F.col("text")).alias("words"))
    return rows.select("row", F.posexplode("words").alias("place", "term"))


def rarest_terms(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """id, window, rare: for each window its rarest terms by their count in ``docs``, the rarest first.

    ``rare`` holds structs of term and offset. Windows with a term that no document
    has are left out.
    """
    placed = windows.select("window", F.posexplode("words").alias("offset", "word")).withColumn(
        "term", _lowered(F.col("word"))
    )
    terms = written(placed.select("term").distinct(), "terms")
    counts = _tokens(docs).join(_bounded(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    member = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "term")
    ranked = placed.join(counts, "term", "left").groupBy("window").agg(F.sort_array(F.collect_list(member)).alias("all"))
    return ranked.where(F.col("all")[0]["df"] > 0).select(
        F.xxhash64("window").alias("id"),
        "window",
        F.transform(F.slice("all", 1, rarest), lambda m: F.struct(m["term"], m["offset"])).alias("rare"),
    )


def store_postings(docs: DataFrame, picks: DataFrame) -> DataFrame:
    """row, term, place of every rare term in ``docs``, written.

    Repeated rows share ``row`` and have their postings once, dropped in the reading tasks
    first, so no list grows with them.
    """
    terms = picks.select(F.explode("rare").alias("r")).select("r.term").distinct()
    return written(_tokens(docs).join(_bounded(terms), "term").select("row", "term", "place").distinct(), "postings")


def intersect(postings: DataFrame, picks: DataFrame, rarest: int = RAREST, slack: int = SLACK) -> DataFrame:
    """row, id, start, exact: where all rare terms of a window stand near their places, or just there.

    Starts before the text are never exact, as the window's first words are missing there.
    Lists are intersected term by term from the rarest on. Postings meet in cells of
    places, so that a start meets those around it alone, however long the text.
    """
    picks = _bounded(picks.select("id", "rare"))
    width = 2 * slack + 1
    cells = postings.select("row", "term", "place", F.floor(F.col("place") / width).alias("cell"))
    first = picks.select("id", F.col("rare")[0]["term"].alias("term"), F.col("rare")[0]["offset"].alias("offset"))
    start = F.col("place") - F.col("offset")
    found = postings.join(first, "term").select("row", "id", start.alias("start"), (start >= 0).alias("exact"))
    for nth in range(1, rarest):
        rows = found.join(picks, "id").withColumn("next", F.get("rare", F.lit(nth)))
        due = F.col("start") + F.col("next.offset")
        asked = rows.where("next is not null").select(
            "row",
            "id",
            "start",
            "exact",
            F.col("next.term").alias("term"),
            due.alias("due"),
            F.explode(F.array_distinct(F.array(F.floor((due - slack) / width), F.floor((due + slack) / width)))).alias(
                "cell"
            ),
        )
        near = asked.join(cells, ["row", "term", "cell"]).where(F.abs(F.col("place") - F.col("due")) <= slack)
        met = near.groupBy("row", "id", "start", "exact").agg(F.max(F.col("place") == F.col("due")).alias("there"))
        met = met.select("row", "id", "start", (F.col("exact") & F.col("there")).alias("exact"))
        found = met.union(rows.where("next is null").select("row", "id", "start", "exact"))
    return found


def _covered(spans: Column) -> Column:
    """Words inside any span; spans are structs of start and length, sorted by start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(end - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, begin, step, lambda state: state["n"])


def _search(docs: DataFrame, items: DataFrame, size: int, rarest: int, slack: int) -> DataFrame:
    """All columns of ``docs`` as kept_0, kept_1, ... and the columns that ``scan`` adds."""
    windows = written(benchmark_windows(items, size), "windows")
    picks = written(rarest_terms(docs, windows, rarest), "picks")
    found = intersect(store_postings(docs, picks), picks, rarest, slack)
    named = _bounded(picks.select("id", "window")).join(windows, "window")
    place = F.struct("start", F.size("words").alias("length"), "words", "items", "window")
    found = (
        found.join(_bounded(named), "id")
        .groupBy(F.col("row").alias("of"))
        .agg(
            F.collect_list(F.when(F.col("exact"), place)).alias("places"),
            F.collect_set("window").alias("near"),
        )
    )
    rows = docs.select(
        *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(docs.columns)],
        F.xxhash64("doc_id", "text").alias("row"),
    )
    text = F.col(f"kept_{docs.columns.index('text')}")
    rows = rows.join(found, F.col("row") == F.col("of"), "left").withColumn(
        "words", F.when(F.size("places") > 0, exact_words(text))
    )
    none = F.array().cast("array<struct<start:int,length:int,items:array<string>,window:string>>")
    checked = F.transform(
        F.filter("places", lambda p: F.slice("words", p["start"] + 1, p["length"]) == p["words"]),
        lambda p: F.struct(p["start"], p["length"], p["items"], p["window"]),
    )
    rows = rows.withColumn(
        "hits", F.when(F.size("words") > 0, F.sort_array(checked)).otherwise(none)
    )
    exact = F.transform("hits", lambda h: h["window"])
    return rows.select(
        *[f"kept_{i}" for i in range(len(docs.columns))],
        F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[0-9A-Za-z\x80-\x{10FFFF}]+")).cast("long").alias("n_words"),
        "hits",
        _covered(F.col("hits")).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))).alias("items"),
        F.coalesce(F.size(F.array_except("near", exact)), F.lit(0)).cast("long").alias("n_near"),
    )


def scan(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, rarest: int = RAREST, slack: int = SLACK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, hits, n_hit, items, n_near.

    ``hits`` are the exact places (start, length, items) of benchmark windows, sorted;
    ``n_hit`` the words inside any; ``items`` the ids, as text and sorted, of the
    items found; ``n_near`` the windows whose rare terms come together within
    ``slack`` words although the window does not occur there or elsewhere in the text.
    Null and empty texts have no words and no hits; items without words have no
    windows; with no items nothing is hit; equal rows get equal results; an empty
    table gives an empty table.
    """
    found = _search(docs.select("doc_id", "text"), items, size, rarest, slack)
    return found.select(F.col("kept_0").alias("doc_id"), "n_words", "hits", "n_hit", "items", "n_near")


def clean(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any benchmark window."""
    found = _search(docs, items, size, RAREST, SLACK).where("n_hit = 0")
    return found.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(docs.columns)])
