"""Mixing sources to target weights over a curriculum that changes with time.

Each source has a target of words and a schedule of weights over training time
from 0 to 1. The integral of a source's schedule is its cumulative demand; the
documents of a source, in an order drawn from their ids, are laid end to end
(and again from the start once they run out), and a document's place in that
line is turned into a training time by inverting the demand. The words all
sources have asked for by then are the document's position in training, and rows
are range-sorted by it.

Running sums never gather a source in one task: documents fall into cells by a
hash, cells are summed first, and only the rows of one cell are summed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.store import written

#: No text is read more often than this; targets stop there too.
MAX_REPEATS = 3
#: Weights of the sources by code point of their names, repeating.
WEIGHTS = (1, 2, 3)
#: How much a source's weight rises (or falls) from the start to the end of training.
SLOPES = (-0.5, 0.0, 0.5)
#: Rows that one ordered sum should hold about; cells follow from it.
ROWS_PER_CELL = 5_000

_WORD = r"[^\x20\x09-\x0D]+"


def row_key() -> Column:
    """A hash that rows with equal id and text share."""
    return F.xxhash64("doc_id", "text")


def with_size(docs: DataFrame) -> DataFrame:
    """doc_id, source, row, size: the words of the whole text, 0 for null."""
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", row_key().alias("row"), size.alias("size"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """One row per source: source, rank, source_size, rows, target.

    Sources share all words by weight. A target stops at ``max_repeats`` times its
    source's size and the excess is shared among the others by weight until none
    is above. In the end the sources with the smallest size per weight are full
    and the others share the rest, so the full ones are found by one running sum
    over sources sorted by size per weight. Sources are a table, not a broadcast
    value; sums over them use one row per source.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    ratio = F.col("source_size") / F.col("weight")
    before = everything.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    shared = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("full_size", F.coalesce(F.sum("source_size").over(before), zero))
        .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), zero))
        # the words left per weight, were all smaller ratios full
        .withColumn(
            "level",
            (F.col("total") - max_repeats * F.col("full_size")) / (F.col("weights") - F.col("full_weight")),
        )
        .withColumn("full", F.col("weight") * F.col("level") > max_repeats * F.col("source_size"))
        .withColumn("rest", F.min(F.when(~F.col("full"), F.struct(ratio, "rank", "level"))).over(everything))
    )
    target = F.when(F.col("full"), max_repeats * F.col("source_size")).otherwise(
        F.col("weight") * F.col("rest.level")
    )
    return shared.select("source", "rank", "source_size", "rows", target.cast("double").alias("target"))


def line_up(sizes: DataFrame, targets: DataFrame, rows_per_cell: int = ROWS_PER_CELL) -> DataFrame:
    """Add the targets' columns and ``start``: the words of the source that come before.

    Documents of a source stand in the order of a digest of their id, so that reruns agree.
    """
    cells = F.ceil(F.col("rows") / rows_per_cell)
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    mark = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long").alias("mark")
    spread = F.col("mark") / 16.0**15  # grows with the mark, so cells are in the marks' order
    rows = sizes.select("doc_id", "source", "row", "size", mark).join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
    )
    rows = rows.drop("of").withColumn("cell", F.floor(spread * cells))
    sums = rows.groupBy("rank", "cell").agg(F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "rank", "cell", F.coalesce(F.sum("cell_size").over(up_to), F.lit(0)).alias("offset")
    )
    in_cell = (
        Window.partitionBy("rank", "cell")
        .orderBy("mark", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("within", F.coalesce(F.sum("size").over(in_cell), F.lit(0)))
        .join(offsets, ["rank", "cell"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("cell", "offset", "within", "mark")
    )


def _slope(rank: Column, slopes: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, slopes)), (rank % len(slopes) + 1).cast("int"))


def time_of(words: Column, target: Column, slope: Column) -> Column:
    """The time by which a source has asked for ``words``: its demand inverted.

    The weight at time t is target * (1 + slope * (2t - 1)), so the demand is
    target * ((1 - slope) * t + slope * t * t).
    """
    share = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(F.lit(0.0))
    straight = F.lit(1.0) - slope
    root = F.sqrt(straight * straight + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - straight) / (2 * slope))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    slopes: tuple[float, ...] = SLOPES,
    max_repeats: int = MAX_REPEATS,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, position, row and positions, one row per row of ``docs``.

    ``taken`` are the words the mix takes, repeats counted: the overlap of the
    document's place in the source's line with the first ``target`` words, the
    line starting again when it ends. ``position`` is the number of words that all
    sources have asked for when the document first comes up; null if it never
    does. ``positions`` has that number for each time it comes up, a last part included.
    ``row`` is ``row_key``. Rows are range-sorted by position. Null texts and empty texts have size
    0 and take nothing; a null source is a source of its own, the last; repeated
    rows are documents of their own; an empty table gives an empty table. Slopes
    lie above -1 and below 1.
    """
    if not all(-1 < s < 1 for s in slopes):
        raise ValueError("slopes lie above -1 and below 1, as weights stay positive")
    sizes = written(with_size(docs), "sizes")
    targets = written(source_targets(sizes, weights, max_repeats), "targets")
    rows = line_up(sizes, targets, rows_per_cell).withColumn("words", F.floor("target"))
    rounds = F.floor(F.col("words") / F.col("source_size"))
    rest = F.col("words") - rounds * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("start"), F.lit(0)), F.col("size"))
    rows = rows.withColumn(
        "taken", F.when(F.col("source_size") > 0, rounds * F.col("size") + part).otherwise(0).cast("long")
    )
    # what all sources ask for by time t: the sum of targets, and of slopes times targets
    demand = targets.agg(
        F.coalesce(F.sum("target"), F.lit(0.0)).alias("words"),
        F.coalesce(F.sum(F.col("target") * _slope(F.col("rank"), slopes)), F.lit(0.0)).alias("tilt"),
    ).first()
    def moment(words: Column) -> Column:
        at = time_of(words, F.col("target"), _slope(F.col("rank"), slopes))
        return F.transform(F.array(at), lambda t: demand["words"] * t + demand["tilt"] * (t * t - t))[0]

    times = (rounds + F.when(part > 0, 1).otherwise(0)).cast("int")
    every = F.transform(F.sequence(F.lit(0), times - 1), lambda k: moment(F.col("start") + k * F.col("source_size")))
    none = F.array().cast("array<double>")
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "taken",
        F.when(F.col("taken") > 0, moment(F.col("start"))).alias("position"),
        "row",
        F.when((F.col("taken") > 0) & (times > 0), every).otherwise(none).alias("positions"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, in the order of their training positions.

    Each time a document comes up it has a row, at that time's position; a last part
    counts if it is half of the document at least, so one of which less is taken goes. The
    rows are range-sorted by position. Equal rows are read as often as all of them together,
    each time at its own position.
    """
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    taken = mix(docs, **settings).select(
        F.col("row").alias("__row"), F.explode(F.slice("positions", F.lit(1), copies)).alias("__position")
    )
    once = docs.withColumn("__row", row_key()).dropDuplicates(["__row"])
    return once.join(taken, "__row").orderBy("__position", "__row").select(*docs.columns)
