"""Whitening against plain integer arithmetic and residuals in extended precision."""

import math

import numpy as np
import pytest

from readloom.llm import whitening as W

SF = "/root/testdata/sf0.01"


def plain(vectors):
    """Exact n, deviations and covariance of whole vectors."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    far = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    y = np.array(x, float) - np.array([s / n for s in sums])
    return n, far, y, y.T @ y / n


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, far, y, cov = plain([v for _, v in rows])
    got = {(r.vec_id, r.component): r for r in W.op13_whitening(spark, SF).collect()}
    assert len(got) == 8 * n
    values, vectors = np.linalg.eigh(cov)
    for k in range(8):
        z = y @ vectors[:, -1 - k] / math.sqrt(values[-1 - k])
        mine = np.array([got[i, k + 1].whitened for i, _ in rows])
        z *= np.sign(z @ mine)
        assert np.allclose(mine, z, atol=1e-8)
    for (i, _), d, row in zip(rows, far, y):
        one = got[i, 1]
        assert one.n == n and one.deviation == d and one.identity_error < 1e-9
    assert abs(got[rows[0][0], 2].explained - values[-2] / np.trace(cov)) < 1e-12


@pytest.mark.parametrize("values", [[9, 5, 2, 1], [7, 7, 7, 1, 1, 0.5], [1, 1 + 1e-9, 1 - 1e-9, 1e-3, 1e-3 + 1e-12, 4], [5, 0, 0, 0], [3, 3, 3]])
def test_refinement(values):
    """Residuals far below float32, where eigenvalues are equal or nearly so as well."""
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(values)) - 0.5 * (q.T @ q))
    v = (q * np.array(values, np.longdouble)) @ q.T
    v = (v + v.T) / 2
    e, x = W.eigen(v)
    assert np.abs(v @ x - x * e).max() < 1e-16 * max(values) * 10
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-16 * 10
    assert np.allclose(e.astype(float), sorted(values, reverse=True), rtol=0, atol=1e-15 * max(values))


def test_nearly_equal_values_are_told_apart():
    v = np.diag(np.array([1, 1 + 1e-10, 1 + 2e-10], np.longdouble))
    turn = np.linalg.qr(np.random.default_rng(2).normal(size=(3, 3)))[0].astype(np.longdouble)
    for _ in range(3):
        turn = turn @ (1.5 * np.eye(3) - 0.5 * (turn.T @ turn))
    e, x = W.eigen(turn @ v @ turn.T)
    assert np.abs(np.abs((turn.T @ x).astype(float)) - np.eye(3)[:, ::-1]).max() < 1e-6


def test_table(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.25]), (1, [0.5, -0.25]), (None, [1.5, 2.0]), (4, None), (5, [None, 1.0]), (6, [inf, 0.0]), (7, [0.0, nan]), (8, [3.0]), (9, [])]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double").repartition(3)
    got = W.whitened(table).collect()
    good = [[0.5, -0.25], [0.5, -0.25], [1.5, 2.0], [3.0, 0.0], [0.0, 0.0]]
    n, far, _, _ = plain(good)
    assert len(got) == 2 * n and {r.vec_id for r in got} == {1, None, 8, 9}
    assert sorted(r.deviation for r in got) == sorted(far * 2)
    assert W.whitened(table.limit(0)).count() == W.whitened(table.where("vec_id = 1")).count() == W.whitened(table.where("vec_id = 9")).count() == 0
    flat = spark.createDataFrame([(i, [float(i % 7), 2.0 * (i % 7)]) for i in range(50)], "vec_id long, embedding array<double>")
    assert {r.component for r in W.whitened(flat).collect()} == {1}


def test_large_numbers(spark):
    """Entries beyond exact products in doubles, and deviations beyond 64 bits."""
    vectors = [[3e9, 1.0], [-3e9, 2.0], [1e300, 0.0], [5.0, 4.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = W.whitened(table).collect()
    assert got and all(r.deviation is None for r in got if r.vec_id < 3)
    _, far, _, _ = plain(vectors[:2])
    small = W.whitened(table.where("vec_id < 2")).collect()
    assert all(r.deviation == (far[r.vec_id] if far[r.vec_id] < 1 << 63 else None) for r in small)
