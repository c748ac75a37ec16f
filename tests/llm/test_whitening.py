"""Whitening against whole numbers and a plain eigenvector routine."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import SMALL

from hazeline.llm import whitening
from hazeline.llm.queries import REGISTRY


def frame(spark, rows, kind="double"):
    clash = [(i, v, "clash") for i, v in rows]
    return spark.createDataFrame(clash, f"vec_id long, embedding array<{kind}>, component string").repartition(3)


def compare(got, rows, components=8):
    names, n, squares, explained, points = brute.whitened(rows, components)
    k = points.shape[1]
    assert len(got) == k * len(names) and {r["n"] for r in got} == {n}
    plain = {}
    for name, square, point in zip(names, squares, points, strict=True):
        plain.setdefault(name, []).append((square, point))
    signs = [0] * k
    top = {(r["vec_id"], r["component"]): r for r in got}
    for (name, component), r in top.items():
        square, point = plain[name][0]
        if len(plain[name]) == 1:
            assert r["deviation"] == (square if square < 1 << 63 else None)
            at = point[component - 1]
            signs[component - 1] = signs[component - 1] or round(r["whitened"] / at) if abs(at) > 0.1 else signs[component - 1]
            assert abs(r["whitened"]) == pytest.approx(abs(at), abs=1e-5)
        assert r["explained"] == pytest.approx(explained[component - 1], rel=1e-6)
        assert r["identity_error"] < 1e-6
    for (name, component), r in top.items():
        if len(plain[name]) == 1 and signs[component - 1]:
            assert r["whitened"] == pytest.approx(signs[component - 1] * plain[name][0][1][component - 1], abs=1e-5)


def test_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(REGISTRY["op12_embedding_whitening"](spark, SMALL).collect(), rows)


def test_odd_rows(spark):
    """Null, non-finite, short and repeated vectors, null and repeated ids, dimensions of unlike size."""
    rng = random.Random(4)
    scale = [1e-3, 1.0, 50.0, 1e3, 1.0]
    rows = [(i, [rng.gauss(0, s) for s in scale]) for i in range(150)]
    rows += [(200 + i, [rng.gauss(0, s) for s in scale[: rng.randrange(6)]]) for i in range(20)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf"), 1.0]), (304, [])]
    rows += [(None, [1.0, 2.0, 3.0]), (305, rows[0][1]), (306, rows[0][1]), (307, rows[1][1]), (307, rows[1][1])]
    compare(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_without_variance(spark):
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got] == [(3, 0, 0, 0, 0)] * 6
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert {(r["component"], r["explained"] > 0.999, r["whitened"] == 0) for r in line if r["vec_id"] != 4} == {
        (1, True, False),
        (2, False, True),
    }
    assert max(r["identity_error"] for r in line) < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e12, 0.5]), (2, [-2e12, 1.5]), (3, [3.0, -7.0]), (4, [1e30, 0.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(frame(spark, rows)).collect() if r["component"] == 1}
    _, n, squares, _, points = brute.whitened(rows[:3], 1)
    assert set(got) == {1, 2, 3} and all(s > 1 << 63 for s in squares) and {r["deviation"] for r in got.values()} == {None}
    assert abs(got[1]["whitened"]) == pytest.approx(abs(points[0][0]), rel=1e-9)


def test_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, []), (2, None)])).collect() == []


@pytest.mark.parametrize("bits", [1, 7, 33, 62])
def test_products_of_planes_are_exact(bits):
    rng = np.random.default_rng(bits)
    x = rng.integers(0, 1 << bits, (131, 4), dtype=np.uint64)
    total = np.zeros((4, 4, 2 * bits), np.int64)
    whitening.add_products(total, x[:100], bits)
    whitening.add_products(total, x[100:], bits)
    plain = x.astype(object)
    for i in range(4):
        for j in range(i, 4):
            assert sum(int(v) << s for s, v in enumerate(total[i, j])) == int((plain[:, i] * plain[:, j]).sum())
