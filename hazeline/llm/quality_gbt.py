"""A quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are counts and shares of characters, words and lines; ids,
sources, languages and labels are no inputs. The trees are fitted on a bounded
sample of labelled rows, complete to one depth, and flattened into arrays of
features, cuts and leaf values, which tasks walk for a whole batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeline.llm import buffers

#: The model is fitted on so many labelled rows at most, chosen by a hash of their ids.
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH, BINS, RATE, MIN_LEAF = 60, 4, 32, 0.15, 20
#: Texts are counted in pieces of so many bytes; larger ones take more memory and no less time.
CHUNK_BYTES = 1 << 18
#: Rows whose id has this remainder are never learned from.
FOLDS = 5
THRESHOLD = 0.3

_CLASSES = np.full(256, 7, np.uint8)
for _kind, _bytes in enumerate(
    (
        range(0x61, 0x7B),
        range(0x41, 0x5B),
        range(0x30, 0x3A),
        (0x20, 0x09, 0x0B, 0x0C, 0x0D),
        (0x0A,),
        b"#*$%&|<>",
        b"!?",
    )
):
    _CLASSES[list(_bytes)] = _kind
_CLASSES[0x80:] = 8
_KINDS = 9

FEATURES = (
    *(f"share_{k}" for k in ("lower", "upper", "digit", "space", "line", "symbol", "shout", "other", "wide")),
    "log_bytes",
    "log_words",
    "mean_word",
    "spread_word",
    "long_words",
    "short_words",
    "distinct_words",
    "top_word",
    "repeated_windows",
    "words_per_line",
    "repeated_lines",
)


def _distinct(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per group: the number of distinct values, and the count of the most frequent one."""
    if not len(value):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    new = np.ones(len(v), bool)
    new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, g[at], np.diff(np.append(at, len(v))))
    return np.bincount(g[at], minlength=n).astype(float), top


def statistics(chunk: buffers.Chunk) -> np.ndarray:
    """One row of FEATURES per text; an empty text has zeros."""
    n, lengths = len(chunk), np.diff(chunk.bounds)
    owner = np.repeat(np.arange(n) * _KINDS, lengths)
    kinds = np.bincount(owner + _CLASSES[chunk.data], minlength=n * _KINDS).reshape(n, _KINDS)
    starts, ends, first = buffers.words(chunk)
    per_text = np.diff(first)
    of = np.repeat(np.arange(n), per_text)
    hashes = buffers.word_hashes(chunk, starts, ends)
    size = (ends - starts).astype(float)
    total = np.bincount(of, size, n)
    square = np.bincount(of, size * size, n)
    some = np.maximum(per_text, 1)
    mean = total / some
    distinct, top = _distinct(of, hashes, n)
    grams = buffers.windows(hashes, 3)
    inside = of[: len(grams)] == of[2:] if len(grams) else np.zeros(0, bool)
    gram_of = of[: len(grams)][inside]
    kinds_of_gram, _ = _distinct(gram_of, grams[inside], n)
    n_grams = np.bincount(gram_of, minlength=n)
    breaks = np.flatnonzero(chunk.data == 0x0A)
    line_start = np.unique(np.concatenate((chunk.bounds[:-1][lengths > 0], breaks + 1)))
    line_start = line_start[line_start < len(chunk.data)]
    line_end = np.append(line_start[1:], len(chunk.data))
    line_of = np.searchsorted(chunk.bounds, line_start, "right") - 1
    lines = np.bincount(line_of, minlength=n)
    kinds_of_line, _ = _distinct(line_of, buffers.own_hashes(chunk, line_start, line_end, folded=False), n)
    return np.column_stack(
        (
            kinds / np.maximum(lengths, 1)[:, None],
            np.log1p(lengths),
            np.log1p(per_text),
            mean,
            np.sqrt(np.maximum(square / some - mean * mean, 0)),
            np.bincount(of, size > 15, n) / some,
            np.bincount(of, size < 3, n) / some,
            distinct / some,
            top / some,
            1 - kinds_of_gram / np.maximum(n_grams, 1) * (n_grams > 0) - (n_grams == 0),
            per_text / np.maximum(lines, 1),
            1 - kinds_of_line / np.maximum(lines, 1) * (lines > 0) - (lines == 0),
        )
    )


def _features_of(column: pa.Array) -> np.ndarray:
    found = [statistics(chunk) for chunk in buffers.chunks(column, CHUNK_BYTES)]
    return np.concatenate(found) if found else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    """Flattened trees: node i of a tree has children 2i + 1 and 2i + 2; leaves come last."""

    prior: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost logistic loss; without rows the score is one half, with one class near that class."""
    empty = np.zeros((0, 2**DEPTH - 1))
    if not len(y):
        return Model(0.0, empty.astype(int), empty, np.zeros((0, 2**DEPTH)))
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    total = np.full(len(y), prior)
    features, bounds, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, bound = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            best = np.full(width, 1e-3)
            split = np.full(width, BINS)
            for f in range(x.shape[1]):
                at = (node - base) * BINS + binned[:, f]
                g, h, n = (
                    np.cumsum(np.bincount(at, w, width * BINS).reshape(width, BINS), axis=1)
                    for w in (grad, hess, None)
                )
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                gain[(n < MIN_LEAF) | (n[:, -1:] - n < MIN_LEAF)] = 0
                gain[:, len(cuts[f]) :] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better], split[better] = value[better], top[better]
                for i in np.flatnonzero(better):
                    feature[base + i], bound[base + i] = f, cuts[f][top[i]]
            right = binned[np.arange(len(y)), feature[node]] > split[node - base]
            node = 2 * node + 1 + right
        slot = node - (2**DEPTH - 1)
        leaf = -RATE * np.bincount(slot, grad, 2**DEPTH) / (np.bincount(slot, hess, 2**DEPTH) + 1)
        total += leaf[slot]
        features.append(feature)
        bounds.append(bound)
        leaves.append(leaf)
    return Model(prior, np.array(features), np.array(bounds), np.array(leaves))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn ``labels.quality`` from the texts of at most ``max_rows`` labelled rows.

    Rows that are held out, or lack an id or a label, are left out. Of several labels
    of an id the largest holds, of several texts the one with the least statistics, so
    an id is one row however often it stands. The sample is broadcast and its statistics
    come to the driver; the parameter bounds both.
    """
    known = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    sample = (
        known.groupBy("doc_id")
        .agg(F.max("quality").cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(_features_of(batch.column("text"))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), x], ["doc_id", "y", "x"])

    kind = rows.schema["doc_id"].dataType
    schema = T.StructType().add("doc_id", kind).add("y", "double").add("x", T.ArrayType(T.DoubleType()))
    by_id = rows.mapInArrow(count, schema).groupBy("doc_id").agg(F.max("y").alias("y"), F.min("x").alias("x"))
    found = sorted(by_id.collect(), key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit_trees(x, np.array([r["y"] for r in found], float))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default) of each row and ``score``, 0 to 1, under ``name``.

    A column that already has that name gives way. Null and empty texts are
    scored on zeros; equal texts get equal scores; an empty table gives an empty table.
    """
    keep = [c for c in (keep or docs.columns) if c != name]
    rows = docs.select(*keep, F.col("text").alias("__scored_text"))
    schema = T.StructType([rows.schema[c] for c in keep]).add(name, "double")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.score(_features_of(batch.column("__scored_text"))), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], [*keep, name])

    return rows.mapInArrow(walk, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 where the score reaches the threshold) for each row of ``docs``."""
    rows = score(docs.select("doc_id", "text"), fit(docs, labels), ["doc_id"])
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold.

    Tasks send each text to Python once and get a score back; the rows themselves stay where they are.
    """
    model = fit(docs, labels)

    def walk(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_features_of(texts)), pa.float64())

    return docs.where(F.arrow_udf(walk, "double")("text") >= threshold)
