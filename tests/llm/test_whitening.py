"""Whitening against plain numpy and exact fractions."""
import math
from fractions import Fraction

import numpy as np
import pytest
from cases import rows_of

from rowlog.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string, whitened int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 7, "x", None) for i, v in vectors], SCHEMA).repartition(3)


def made(seed=1, n=90, d=9):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d)) @ r.normal(size=(d, d)) + 3
    return [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]


def brute(vectors):
    """x, n, S, the exact covariance as doubles."""
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    mean = [Fraction(t, n) for t in s]
    cov = np.array([[float(sum((r[j] - mean[j]) * (r[k] - mean[k]) for r in x) / n) for k in range(d)] for j in range(d)])
    return x, n, s, cov


def test_equals_exact_arithmetic(spark):
    rows = made()
    odd = [(900, None), (901, [float("nan")] * 9), (902, [1.0, None] + [0.0] * 7), (903, [float("inf")] + [0.0] * 8), (904, []), (905, [1.0]),
           (906, [3e38] * 9), (5, rows[5][1])]
    df, fit = whitening.whiten(frame(spark, rows + odd))
    x, n, s, cov = brute([v for _, v in rows] + [rows[5][1]])
    assert (fit.n, list(fit.sums)) == (n, s) and (fit.covariance == cov).all()
    value, axis = np.linalg.eigh(cov)
    value, axis = value[::-1], axis[:, ::-1]
    got = whitening.digest(df, fit).collect()
    assert len(got) == n * 9
    ids = [i for i, _ in rows] + [5]
    want = {}
    for i, r in zip(ids, x, strict=True):
        want[i] = [float(Fraction(a * n - b, n)) for a, b in zip(r, s, strict=True)]
    for r in got:
        j = r.component - 1
        w = float(np.dot(want[r.vec_id], axis[:, j]) / math.sqrt(value[j]))
        assert min(abs(r.whitened - w), abs(r.whitened + w)) < 1e-6
        assert abs(r.explained / (value[j] / value.sum()) - 1) < 1e-9 and r.identity_error < 1e-9 and r.n == n
    exact = {i: sum((a * n - b) ** 2 for a, b in zip(r, s, strict=True)) for i, r in zip(ids, x, strict=True)}
    assert {r.vec_id: r.deviation for r in got} == exact


def test_only_the_largest_components_are_kept(spark):
    df, fit = whitening.whiten(frame(spark, made(2, 60, 40)))
    got = whitening.digest(df, fit)
    assert got.count() == 60 * 32 and got.agg({"component": "max"}).first()[0] == 32
    assert (np.diff(fit.eigenvalues) <= 0).all()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    df, fit = whitening.whiten(frame(spark, rows))
    got = whitening.digest(df, fit)
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_a_flat_dimension_has_no_component(spark):
    rows = [(i, [float(i % 7), 2.0, float(i * i % 11)]) for i in range(50)]
    df, fit = whitening.whiten(frame(spark, rows))
    assert len(fit.eigenvalues) == 2 and fit.identity_error < 1e-9
    assert {r.component for r in whitening.digest(df, fit).collect()} == {1, 2}


@pytest.mark.parametrize("bits", [3, 20, 40, 60, 70])
def test_square_sums_are_exact(bits):
    r = np.random.default_rng(bits)
    z = np.array([[int(x) * (1 << max(bits - 30, 0)) + i for i, x in enumerate(row)] for row in r.integers(-(1 << min(bits, 30)), 1 << min(bits, 30), (1500, 3))], object)
    if bits < 62:
        z = z.astype(np.int64)
    got = whitening.pair_squares(z)
    rows = [[int(c) for c in row] for row in z.tolist()]
    for j in range(3):
        assert got[j] == [sum((c[j] + (c[k] if k != j else 0)) ** 2 for c in rows) for k in range(j, 3)]


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2 ** 40 + 2 ** 20 * i), float(-(2 ** 45) * (i % 3)), 1.0 * i]) for i in range(40)]
    df, fit = whitening.whiten(frame(spark, rows))
    _, n, s, cov = brute([v for _, v in rows])
    assert (fit.n, list(fit.sums)) == (n, s) and (fit.covariance == cov).all()
    assert rows_of(whitening.digest(df, fit).where("component = 1"), "deviation") == [(None,)] * 40
