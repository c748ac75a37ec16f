"""Embedding whitening: exact cross-products from bit planes, then eigenvectors.

Entries become whole numbers, shifted by the least one of their dimension. Of a batch of
rows each dimension is cut into bit planes, and a plane is packed into words of 64 rows.
The sum of products of two dimensions is a weighted sum over pairs of planes of the bits
that both have set: AND, then a count of ones, no multiplication of entries and no
rounding. Tasks add up one square of dimensions, so what leaves a task and what reaches
the driver depends on the number of dimensions only. There the sums are centred as whole
numbers of any size, and only then turned into doubles for the eigenvectors.

Defined cases: a vector that is null, or holds a null or non-finite entry, or one whose
whole number exceeds 62 bits, is left out. Vectors shorter than the longest one are read
as ending in zeros. Repeated rows count as often as they stand. A component without
variance (all vectors alike, more components than vectors) has ``whitened`` and
``explained`` 0 and does not enter ``identity_error``, which is 0 where no component has
variance. ``deviation`` is null where the exact figure exceeds a long. An empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows that are cut into planes at a time.
BLOCK_ROWS = 1 << 13
#: A component counts as without variance below this share of the largest eigenvalue, per dimension.
FLAT = 1e-14

_LIMIT = float(1 << 62)
_LONG = (1 << 63) - 1


def whole(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The rows that stay, and their whole numbers as an array of rows by ``width`` dimensions."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.asarray(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    entries = vectors.flatten()
    values = np.asarray(entries.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(values * SCALE) + OFFSET
        good = np.abs(values) < _LIMIT  # false for nulls, which read as NaN
    owner = np.repeat(np.arange(len(lengths)), lengths)
    stays = np.asarray(vectors.is_valid().to_numpy(zero_copy_only=False), bool)
    stays = stays & (np.bincount(owner[~good], minlength=len(lengths)) == 0)
    width = int(lengths[stays].max(initial=0)) if width is None else width
    rows = np.flatnonzero(stays)
    out = np.full((len(rows), width), OFFSET, np.int64)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = stays[owner]
    out[(np.cumsum(stays) - 1)[owner[inside]], place[inside]] = values[inside].astype(np.int64)
    return rows, out


def _limbs(values) -> tuple[list[int], list[int]]:
    """Whole numbers of any size as longs: value = high * 2 ** 32 + low."""
    values = [int(v) for v in values]
    return [v >> 32 for v in values], [v & 0xFFFFFFFF for v in values]


def _total(name: str):
    """The sum of limbs, as a decimal: more rows than a long could add up."""
    high, low = (F.sum(F.col(f"{name}_{part}").cast("decimal(20,0)")) for part in ("high", "low"))
    return high.alias(f"{name}_high"), low.alias(f"{name}_low")


def _whole_total(row, name: str) -> int:
    return (int(row[f"{name}_high"]) << 32) + int(row[f"{name}_low"])


@dataclass
class Fit:
    """The fit list: its size, sums per dimension, and components in order of eigenvalue."""

    n: int = 0
    sums: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    axes: np.ndarray | None = None  # dimensions x components, divided by the root of the eigenvalue
    explained: np.ndarray | None = None


def _moments(vectors: DataFrame) -> Fit:
    """Size of the fit list, and sum, least and greatest entry of each dimension."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row a dimension and task; zeros that stand in for missing ends are added by the caller.
        n, total, low, high, seen = 0, [], [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.column(0).slice(at, BLOCK_ROWS)
                rows, x = whole(piece)
                if not len(rows):
                    continue
                lengths = np.asarray(piece.value_lengths().to_numpy(zero_copy_only=False))[rows]
                more = x.shape[1] - len(total)
                total += [0] * more
                low += [_LONG] * more
                high += [-_LONG] * more
                seen += [0] * more
                n += len(rows)
                for d in range(x.shape[1]):
                    there = x[lengths > d, d]
                    if len(there):
                        total[d] += (int((there >> 32).sum()) << 32) + int((there & 0xFFFFFFFF).sum())
                        low[d], high[d] = min(low[d], int(there.min())), max(high[d], int(there.max()))
                        seen[d] += len(there)
        if n:
            sum_high, sum_low = _limbs([n, *total])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(-1, len(total)), pa.int32()),
                    pa.array(sum_high, pa.int64()),
                    pa.array(sum_low, pa.int64()),
                    pa.array([0, *low], pa.int64()),
                    pa.array([0, *high], pa.int64()),
                    pa.array([n, *seen], pa.int64()),
                ],
                ["d", "sum_high", "sum_low", "low", "high", "seen"],
            )

    parts = vectors.mapInArrow(count, "d int, sum_high long, sum_low long, low long, high long, seen long")
    found = parts.groupBy("d").agg(*_total("sum"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("seen").alias("seen"))
    rows = {r["d"]: r for r in found.collect()}
    if not rows:
        return Fit()
    n = int(rows[-1]["seen"])
    fit = Fit(n)
    for d in range(max(rows) + 1):
        missing = n - int(rows[d]["seen"])
        fit.sums.append(_whole_total(rows[d], "sum") + missing * OFFSET)
        fit.low.append(min(rows[d]["low"], OFFSET) if missing else rows[d]["low"])
        fit.high.append(max(rows[d]["high"], OFFSET) if missing else rows[d]["high"])
    return fit


def planes(x: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of non-negative columns, ``bits`` for each, packed into words of 64 rows."""
    n, width = x.shape
    padded = np.zeros((width, -(-max(n, 1) // 64) * 64), np.uint64)
    padded[:, :n] = x.T
    shifts = np.arange(bits, dtype=np.uint64)
    set_ = ((padded[:, None, :] >> shifts[None, :, None]) & np.uint64(1)).astype(np.uint8)
    return np.packbits(set_, axis=2, bitorder="little").view(np.uint64)


def add_products(total: np.ndarray, x: np.ndarray, bits: int) -> None:
    """Add, for dimensions i <= j and s, the pairs of set bits whose weights multiply to 2 ** s."""
    cut = planes(x, bits)
    for i in range(len(cut)):
        for b in range(bits):
            if cut[i, b].any():
                met = np.bitwise_count(cut[i, b] & cut[i:]).sum(axis=2, dtype=np.int64)
                total[i, i:, b : b + bits] += met


def _products(vectors: DataFrame, fit: Fit) -> list[list[int]]:
    """Sums of products of the shifted entries of each two dimensions, exact."""
    width = len(fit.sums)
    low = np.array(fit.low, np.int64)
    bits = max((h - l for h, l in zip(fit.high, fit.low, strict=True)), default=0).bit_length()
    first, second = np.triu_indices(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width, 2 * bits), np.int64), False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows, x = whole(batch.column(0).slice(at, BLOCK_ROWS), width)
                if len(rows):
                    some = True
                    add_products(total, x.astype(np.uint64) - low.astype(np.uint64), bits)
        if some:
            weights = np.array([1 << s for s in range(2 * bits)], object)
            high, small = _limbs(total[first, second].astype(object) @ weights if bits else [0] * len(first))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first, pa.int32()),
                    pa.array(second, pa.int32()),
                    pa.array(high, pa.decimal128(38, 0)),
                    pa.array(small, pa.int64()),
                ],
                ["i", "j", "sum_high", "sum_low"],
            )

    parts = vectors.mapInArrow(multiply, "i int, j int, sum_high decimal(38,0), sum_low long")
    sums = parts.groupBy("i", "j").agg(
        F.sum("sum_high").alias("sum_high"), F.sum(F.col("sum_low").cast("decimal(20,0)")).alias("sum_low")
    )
    out = [[0] * width for _ in range(width)]
    for r in sums.collect():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = _whole_total(r, "sum")
    return out


def fit_components(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    """Fit on all rows of the one column of ``vectors``.

    The driver holds a square of dimensions and no rows.
    """
    fit = _moments(vectors)
    width = len(fit.sums)
    if not fit.n or not width:
        return fit
    products, n = _products(vectors, fit), fit.n
    shifted = [s - n * low for s, low in zip(fit.sums, fit.low, strict=True)]
    # n * n times the covariance, as whole numbers: shifts cancel.
    centred = [[n * products[i][j] - shifted[i] * shifted[j] for j in range(width)] for i in range(width)]
    trace = sum(centred[d][d] for d in range(width))
    covariance = np.array([[value / (n * n) for value in row] for row in centred])
    eigenvalues, axes = np.linalg.eigh(covariance)
    eigenvalues, axes = eigenvalues[::-1][:components], axes[:, ::-1][:, :components]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    some = eigenvalues > max(FLAT * width * eigenvalues[0], 0.0)
    fit.explained = np.where(some, eigenvalues / (trace / (n * n) if trace else 1.0), 0.0)
    fit.axes = np.where(some, axes / np.sqrt(np.where(some, eigenvalues, 1.0)), 0.0)
    return fit


def _centred(x: np.ndarray, fit: Fit) -> tuple[np.ndarray, list[int | None]]:
    """x - S / n from the exact n * x - S, and the exact sum of squares of the latter."""
    reach = max(max(h * fit.n - s, s - l * fit.n) for h, l, s in zip(fit.high, fit.low, fit.sums, strict=True))
    if len(fit.sums) * reach * reach <= _LONG and max(map(abs, [*fit.high, *fit.low])) * fit.n <= _LONG:
        by_n = fit.n * x - np.array(fit.sums, np.int64)
        return by_n / fit.n, (by_n * by_n).sum(axis=1).tolist()
    by_n = fit.n * x.astype(object) - np.array(fit.sums, object)
    squares = [int(v) for v in (by_n * by_n).sum(axis=1)]
    return (by_n / fit.n).astype(float), [v if v <= _LONG else None for v in squares]


def _identity_error(vectors: DataFrame, fit: Fit) -> float:
    """How far the covariance of all whitened rows is from the identity, at most."""
    live = np.flatnonzero(fit.explained > 0)
    if not len(live):
        return 0.0
    first, second = np.triu_indices(len(live))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((len(live), len(live))), np.zeros(len(live))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                _, x = whole(batch.column(0).slice(at, BLOCK_ROWS), len(fit.sums))
                w = _centred(x, fit)[0] @ fit.axes[:, live]
                total += w.T @ w
                sums += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*first, *live * 0 - 1], pa.int32()),
                pa.array([*second, *range(len(live))], pa.int32()),
                pa.array([*total[first, second], *sums]),
            ],
            ["i", "j", "total"],
        )

    parts = vectors.mapInArrow(multiply, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    total = {(r["i"], r["j"]): r["total"] / fit.n for r in parts.collect()}
    return float(
        max(
            abs(total[i, j] - total[-1, i] * total[-1, j] - (i == j))
            for i, j in zip(first.tolist(), second.tolist(), strict=True)
        )
    )


def whiten(
    table: DataFrame, components: int = COMPONENTS, vector: str = "embedding", name: str = "vec_id"
) -> DataFrame:
    """One row for each vector and component: the columns of ``op12``'s result.

    ``name`` is carried as it is, null and repeated ones included. See the module for
    vectors that are left out and for the other defined cases.
    """
    rows = table.select(name, vector)
    kind = rows.schema[name].dataType
    schema = (
        T.StructType()
        .add(name, kind)
        .add("component", "integer")
        .add("n", "long")
        .add("deviation", "long")
        .add("whitened", "double")
        .add("explained", "double")
        .add("identity_error", "double")
    )
    fit = fit_components(rows.select(vector), components)
    if fit.axes is None:
        return table.sparkSession.createDataFrame([], schema)
    error, width, k = _identity_error(rows.select(vector), fit), len(fit.sums), fit.axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(at, BLOCK_ROWS)
                kept, x = whole(piece.column(1), width)
                apart, squares = _centred(x, fit)
                n = len(kept) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(np.repeat(kept, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(kept))),
                        pa.array(np.full(n, fit.n, np.int64)),
                        pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(len(kept)), k))),
                        pa.array((apart @ fit.axes).reshape(-1)),
                        pa.array(np.tile(fit.explained, len(kept))),
                        pa.array(np.full(n, error)),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(project, schema)
