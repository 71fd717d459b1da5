"""Whitening against numpy's own solver in double precision, on awkward vectors and clustered eigenvalues."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlake.llm import whitening

FIELDS = "vec_id bigint, embedding array<double>"


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) and abs(256 * x) < 2**62 for x in v)


def brute(rows, components=4):
    """Per id and component: n, deviation, |whitened|, explained."""
    out = {}
    for dim in {len(v) for _, v in rows if usable(v)}:
        x = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if usable(v) and len(v) == dim]
        fit = sorted({v for _, v in x})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        apart = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
        v = apart.T @ apart / n
        values, basis = np.linalg.eigh(v)
        for i, w in x:
            place = np.array([(n * c - s) / n for c, s in zip(w, sums)])
            for k in range(min(components, dim)):
                e = values[-1 - k]
                white = abs(place @ basis[:, -1 - k]) / math.sqrt(e) if e > 1e-12 * np.trace(v) else None
                share = e / np.trace(v) if np.trace(v) > 0 else None
                out.setdefault((i, dim, k + 1), []).append((n, sum((n * c - s) ** 2 for c, s in zip(w, sums)), white, share))
    return out


def compare(got, want, dims):
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        n, deviation, white, share = want[r.vec_id, dims[r.vec_id], r.component][0]
        assert r.n == n and r.deviation == (deviation if deviation < 2**63 else None)
        assert (r.whitened is None) == (white is None) and (white is None or abs(abs(r.whitened) - white) < 1e-7 * max(1, white))
        assert (r.explained is None) == (share is None) and (share is None or abs(r.explained - share) <= 1e-9)
        assert r.identity_error is None or r.identity_error < 1e-9


def test_whitening_equals_numpy(spark):
    draw = np.random.default_rng(3)
    scale = np.array([5, 4, 3, 2, 1, 0.5, 0.2])
    rows = [(i, (draw.normal(size=7) * scale).tolist()) for i in range(400)]
    rows += [(1000 + k, rows[k][1]) for k in range(50)] * 3
    rows += [(2000 + k, [x + 1e-4 for x in rows[7][1]]) for k in range(3)]
    df = spark.createDataFrame(rows, FIELDS).repartition(5).withColumn("dim", F.lit("x")).withColumn("body", F.lit(1))
    got = whitening.whiten(df).collect()
    compare(got, brute(rows), {i: 7 for i, _ in rows})
    # The same direction for all rows: places of a component are those of one axis, either way round.
    first = {r.vec_id: r.whitened for r in got if r.component == 1}
    assert abs(np.corrcoef([first[i] for i in range(400)], [rows[i][1][0] for i in range(400)])[0, 1]) > 0.9


def test_awkward_vectors(spark):
    rows = [(1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1e300, 1.0])]
    rows += [(10, [-0.0, 0.0]), (11, [0.001, -0.001]), (12, [1.0, 2.0]), (13, [1.0, 2.0]), (20, [3.0]), (30, [1.0, 1.0, 5.0]), (31, [2.0, 2.0, 5.0])]
    rows += [(40 + i, [1e13 + i, -1e12, 0.5 * i, 3.0]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, FIELDS).repartition(4)).collect()
    compare(got, brute(rows), {i: len(v) for i, v in rows if v})
    assert {r.vec_id for r in got} == {10, 11, 12, 13, 20, 30, 31, *range(40, 46)}
    alone = [r for r in got if r.vec_id == 20]
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, None, None)]
    none = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (None, [3.0, 2.0])], FIELDS)).collect()
    assert len(none) == 4 and all(r.vec_id is None for r in none)


def test_empty(spark):
    assert whitening.whiten(spark.createDataFrame([], FIELDS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], FIELDS)).count() == 0


def test_large_sums(spark):
    """Sums beyond 64 bits stay exact; a deviation that does not fit is null."""
    rows = [(i, [9e15 + 1024 * i, 1.0 * i]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, FIELDS).repartition(2)).collect()
    want = brute(rows)
    assert {r.vec_id: r.deviation for r in got} == {i: want[i, 2, 1][0][1] for i, _ in rows}
    far = [(0, [1e16, 0.0]), (1, [-1e16, 0.0])]
    assert all(r.deviation is None for r in whitening.whiten(spark.createDataFrame(far, FIELDS)).collect())


@pytest.mark.parametrize("values", [
    np.geomspace(1, 1e-6, 40), np.r_[np.ones(20) + 1e-9 * np.arange(20), np.linspace(0.5, 0.1, 20)], np.ones(12), np.r_[np.full(5, 3.0), np.full(5, 3 + 1e-12), 1e-3],
    np.r_[1e30, 1e29, 1e28, np.zeros(4)], [2.0],
])
def test_eigen(values):
    """Residuals and orthogonality near double precision, however close the eigenvalues lie."""
    values = np.asarray(values, float)
    turn = np.linalg.qr(np.random.default_rng(len(values)).normal(size=(len(values), len(values))))[0]
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    got, x = whitening.eigen(a)
    top = values.max()
    assert np.abs(got - np.sort(values)[::-1]).max() <= 1e-14 * len(values) * top
    assert np.abs(a @ x - x * got).max() <= 1e-14 * len(values) * top
    assert np.abs(x.T @ x - np.eye(len(values))).max() <= 1e-13
