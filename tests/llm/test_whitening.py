"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from quizmill.llm.whitening import Fit, bidiagonalise, integer_rows, whiten

SCHEMA = "vec_id long, embedding array<double>, x string, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "extra", 3) for i, v in rows], SCHEMA)


def dense(rows, most=16):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s).astype(float) / n
    cov = y.T @ y / n
    e, w = np.linalg.eigh(cov)
    e, w = e[::-1][:most], w[:, ::-1][:, :most]
    white = ((n * x - s).astype(float) / n) @ w / np.sqrt(e)
    deviation = [int(sum(int(c) ** 2 for c in r)) for r in n * x - s]
    return [i for i, _ in good], n, deviation, white, e / np.trace(cov)


def check(spark, rows, least_gap=True):
    ids, n, deviation, white, explained = dense(rows)
    got = whiten(frame(spark, rows)).collect()
    k = max(r.component for r in got)
    assert len(got) == len(ids) * k and {r.n for r in got} == {n}
    table = {(r.vec_id, r.component): r for r in got}
    for j in range(k):
        assert abs(table[ids[0], j + 1].explained / explained[j] - 1) < 1e-9
        mine = np.array([table[i, j + 1].whitened for i in ids])
        if least_gap:
            assert min(abs(mine - white[:, j]).max(), abs(mine + white[:, j]).max()) < 1e-6
    assert [table[i, 1].deviation for i in ids] == deviation
    assert max(r.identity_error for r in got) < 1e-8
    return k


def test_against_eigendecomposition(spark):
    draw = np.random.default_rng(1)
    rows = [(int(i), (draw.standard_normal(24) * np.linspace(3, 0.2, 24)).tolist()) for i in range(400)]
    rows += [(1000, rows[0][1]), (1001, None), (1002, [float("nan")] + [0.0] * 23), (1003, [None] + [0.0] * 23),
             (1004, [float("inf")] + [0.0] * 23), (1005, []), (1006, [0.0] * 24)]
    assert check(spark, rows) == 16


def test_fewer_dimensions_than_components_and_dependent_ones(spark):
    draw = np.random.default_rng(2)
    base = draw.integers(-20, 20, (150, 3))
    rows = [(int(i), [float(a) / 64, float(b) / 64, float(c) / 64, float(a + b) / 64, float(a - c) / 64]) for i, (a, b, c) in enumerate(base)]
    assert check(spark, rows) == 3


def test_equal_variances_come_out_each(spark):
    """Every sign pattern: all variances are equal, one start vector alone would find one component."""
    rows = [(m, [1.0 if m >> d & 1 else -1.0 for d in range(6)]) for m in range(64)]
    got = whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == set(range(1, 7)) and max(r.identity_error for r in got) < 1e-9
    assert all(abs(r.explained - 1 / 6) < 1e-12 for r in got)


def test_bidiagonal_form(spark):
    draw = np.random.default_rng(4)
    rows = [(int(i), draw.standard_normal(10).tolist()) for i in range(60)]
    x = integer_rows(frame(spark, rows), "vec_id", "embedding").select("x").distinct()
    fit = Fit(x)
    b, v = bidiagonalise(fit)
    y = fit.centred(np.array([r.x for r in x.collect()]))
    assert np.allclose(v.T @ v, np.eye(10), atol=1e-12)
    assert np.allclose(b, np.triu(np.tril(b, 1)))
    assert np.allclose(np.linalg.svd(y)[1], np.linalg.svd(b)[1], rtol=1e-10)
    u = y @ v @ np.linalg.inv(b)
    assert np.allclose(u.T @ u, np.eye(10), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, None)]])
def test_nothing_to_fit(spark, rows):
    assert whiten(frame(spark, rows)).collect() == []


def test_other_lengths_are_left_out(spark):
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0]), (4, [2.0, 2.0])]
    assert {r.vec_id for r in whiten(frame(spark, rows)).collect()} == {1, 2, 4}


def test_large_deviations_stay_exact(spark):
    rows = [(i, [float(i * 3_000_000), float(i % 3)]) for i in range(40)]
    ids, n, deviation, _, _ = dense(rows)
    got = {r.vec_id: r.deviation for r in whiten(frame(spark, rows)).collect()}
    assert [got[i] for i in ids] == [x if x < 2 ** 63 else None for x in deviation]
