"""Quality rules: divergence of a document from its language's reference.

Base rules count words, symbols, repeated lines and repeated three-word windows.
The method compares a document's histogram of character classes and its histogram
of common words with references of its language by the Jensen-Shannon distance.
References are means over all documents of a language that pass the base rules, so
they are learned from the whole corpus; a histogram is only judged when enough
words stand behind it. The mean over all languages counts in each language's reference
as if it were PRIOR documents more, so a language with few documents, or an unknown one, is
judged by what all languages have in common, and no number of documents turns the
judgement on or off.

Only built-in functions are used. Counts of a document are taken in one pass and
written; references and verdicts read the counts, not the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.store import written

MIN_WORDS = 50
#: Histograms of fewer words are not judged.
MIN_WORDS_CLASSES = 50
MIN_WORDS_COMMON = 200
#: As many documents of its own outweigh what a language's reference takes from all languages.
PRIOR = 20
#: Largest distances (0 to 1) that still pass.
MAX_CLASS_DISTANCE = 0.32
MAX_COMMON_DISTANCE = 0.27

_WORD = r"[^\x20\x09-\x0D]+"
#: Character classes, of which whitespace and lower-case ASCII are the rest.
CLASSES = {
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "symbol": r"[#*$%&|<>]+",
    "punct": r"[!-\x22'-)+-/:;=?@\[-`{}~]+",
    "wide": r"[^\x00-\x7F]+",
}
#: The common words of a language.
COMMON = {
    "en": "the of and to a in is that it for was on with as by".split(),
    "fr": "de la le et les en des un du une que pour est par avec".split(),
    "de": "der die und in den von zu das sich mit des auf für ist im".split(),
    "es": "de la que el en y los las se del un por con no una".split(),
}
_SLOTS = max(map(len, COMMON.values()))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that the text has twice or more."""
    empty = F.array().cast("array<bigint>")

    def count(grams: Column) -> Column:
        def covered(ordered: Column) -> Column:
            again = F.array_distinct(F.filter(ordered, lambda g, i: (i > 0) & (g == F.get(ordered, i - 1))))
            return F.when(F.size(again) == 0, F.lit(0)).otherwise(
                _let(F.array_except(grams, again), lambda single: _cover(grams, single))
            )

        return _let(F.sort_array(grams), covered)

    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return _let(F.when(F.size(words) >= 4, grams).otherwise(empty), count)


def _cover(grams: Column, single: Column) -> Column:
    """Walk the windows beside those that occur once, which keep their order."""
    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state: Column, i: Column) -> Column:
        alone = F.coalesce(F.get(grams, i) == F.get(single, state["next"]), F.lit(False))
        return F.when(
            alone,
            F.struct((state["next"] + 1).alias("next"), state["end"].alias("end"), state["n"].alias("n")),
        ).otherwise(
            F.struct(
                state["next"].alias("next"),
                (i + 3).alias("end"),
                (state["n"] + i + 3 - F.greatest(i, state["end"])).alias("n"),
            )
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(grams) - 1), start, step, lambda state: state["n"])


def _common(words: Column, lang: Column) -> Column:
    """How often each common word of the language stands in the text, as an array."""
    chosen = F.array().cast("array<string>")
    for name, listed in reversed(COMMON.items()):
        chosen = F.when(lang == name, F.array(*map(F.lit, listed))).otherwise(chosen)
    every = sorted({w for listed in COMMON.values() for w in listed})
    found = F.filter(words, lambda w: w.isin(every))
    return _let(
        found,
        lambda hits: F.transform(chosen, lambda c: F.size(F.filter(hits, lambda w: w == c))),
    )


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts of each whole text; a null text counts as no text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "lang", text.alias("text"), F.regexp_extract_all(text, F.lit(_WORD), 0).alias("words")
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    length = F.length("text")
    return rows.select(
        "doc_id",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        length.cast("long").alias("chars"),
        _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))
        .cast("long")
        .alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        _common(F.col("words"), F.col("lang")).alias("common"),
        *[
            (length - F.length(F.regexp_replace("text", pattern, ""))).cast("long").alias(f"n_{name}")
            for name, pattern in CLASSES.items()
        ],
    )


def _histograms(counts: DataFrame) -> DataFrame:
    rare = [F.col(f"n_{name}") for name in CLASSES]
    space = F.col("chars") - F.col("word_chars")
    lower = F.col("chars") - space - sum(rare, F.lit(0))
    share = [x / F.col("chars") for x in (lower, space, *rare)]
    words = [F.coalesce(F.get("common", F.lit(i)), F.lit(0)) for i in range(_SLOTS)]
    known = F.aggregate("common", F.lit(0), lambda total, n: total + n)
    return counts.withColumn("classes", F.when(F.col("chars") > 0, F.array(*share))).withColumn(
        "usual",
        F.when(
            F.col("n_words") > 0,
            F.array(*[w / F.col("n_words") for w in words], (F.col("n_words") - known) / F.col("n_words")),
        ),
    )


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two histograms that sum to 1."""

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: (term(a, b) + term(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x), F.lit(0.0)))


def _means(rows) -> DataFrame:
    """good, classes and usual: the number of documents and the means of their histograms."""
    bins = len(CLASSES) + 2
    return rows.agg(
        F.count(F.lit(1)).alias("good"),
        F.array(*[F.round(F.avg(F.get("classes", F.lit(i))), 9) for i in range(bins)]).alias("classes"),
        F.array(*[F.round(F.avg(F.get("usual", F.lit(i))), 9) for i in range(_SLOTS + 1)]).alias("usual"),
    )


def apply_rules(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_words_classes: int = MIN_WORDS_CLASSES,
    min_words_common: int = MIN_WORDS_COMMON,
    prior: int = PRIOR,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_common_distance: float = MAX_COMMON_DISTANCE,
) -> DataFrame:
    """One row per row of ``docs`` with its counts, distances and verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, common_distance, kept. A distance is null where the
    guards leave it out, which never rejects, and everywhere if no document of the table
    passes the base rules. Null and empty texts have no words and
    fail the base rules; a null or unknown language forms a group like any other and
    has no common words; repeated rows are judged alike; an empty table gives an
    empty table.
    """
    counts = _histograms(written(text_counts(docs), "rule-counts")).withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    )
    good = counts.where(~F.col("base_failed"))
    # One row; and one row per language.
    shared, by_lang = _means(good.groupBy()).first(), _means(good.groupBy(F.col("lang").alias("of")))
    common = {name: F.array(*[F.lit(v).cast("double") for v in shared[name]]) for name in ("classes", "usual")}

    def mixed(name: str) -> Column:
        summed = F.zip_with(
            name, common[name], lambda a, b: F.round((a * F.col("good") + b * prior) / (F.col("good") + prior), 9)
        )
        return summed.alias(f"{name}_of")

    # Languages without a good document take what all have.
    judged = counts.join(by_lang.select("of", mixed("classes"), mixed("usual")), F.col("lang").eqNullSafe(F.col("of")), "left")
    judged = judged.withColumns({f"{name}_of": F.coalesce(f"{name}_of", common[name]) for name in common})
    judged = judged.withColumn("has_reference", F.lit(shared["good"] > 0))
    class_distance = F.when(
        (F.col("n_words") >= min_words_classes) & F.col("has_reference"), distance(F.col("classes"), F.col("classes_of"))
    )
    common_distance = F.when(
        (F.col("n_words") >= min_words_common) & F.col("has_reference") & (F.size("common") > 0),
        distance(F.col("usual"), F.col("usual_of")),
    )
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > max_class_distance) | (
        F.coalesce(F.col("common_distance"), F.lit(0.0)) > max_common_distance
    )
    return (
        judged.withColumn("class_distance", F.round(class_distance, 6))
        .withColumn("common_distance", F.round(common_distance, 6))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            F.col("n_symbol").alias("n_symbols"),
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "class_distance",
            "common_distance",
            (~F.col("base_failed") & ~far).alias("kept"),
        )
    )
