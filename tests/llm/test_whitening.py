"""Whitening against numpy's eigenvalues and exact fractions, and on odd rows."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerwright.llm import whitening

KIND = "vec_id long, embedding array<float>, label int, x string"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "mine") for i, v in rows], KIND)


def _vectors(n, d, seed=3):
    draw = np.random.default_rng(seed)
    mixed = draw.standard_normal((n, d)) @ draw.standard_normal((d, d)) * 0.1 + draw.standard_normal(d)
    return mixed.astype(np.float32).tolist()


def test_rows_equal_exact_sums_and_numpy(spark):
    vectors = _vectors(300, 12)
    rows = list(enumerate(vectors)) + [(1000 + k, vectors[0]) for k in range(200)]  # copies weigh nothing
    rows += [(7, vectors[7]), (None, vectors[8]), (2000, None), (2001, [1.0] * 11 + [None]),
             (2002, [float("nan")] * 12), (2003, [float("inf")] * 12), (2004, [0.5] * 3), (2005, [])]
    got = whitening.whiten(_table(spark, rows).repartition(7)).collect()
    assert len(got) == 4 * (300 + 200 + 2)
    x = {i: [math.floor(256 * c) for c in v] for i, v in enumerate(vectors)}
    distinct = sorted({tuple(v) for v in x.values()})
    n, total = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, total)] for v in distinct])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    by = {(r.vec_id, r.component): r for r in got if r.vec_id is not None and r.vec_id != 7}
    sign = {}
    for i, v in x.items():
        if i == 7:
            continue
        want = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, total)])
        for k in range(4):
            r = by[i, k + 1]
            z = want @ axes[:, k] / math.sqrt(values[k])
            sign.setdefault(k, 1 if r.whitened * z > 0 else -1)
            assert r.whitened == pytest.approx(sign[k] * z, abs=1e-9)
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(v, total))
            assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-12)
            assert r.identity_error < 1e-9
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == 7 for r in got) == 8


@pytest.mark.parametrize("values", [
    [5.0, 4.0, 3.0, 2.0, 1.0, 0.5], [3.0, 3.0, 3.0, 1.0, 1.0], [1.0] * 6, [1e6, 1.0, 1e-6, 0.0, 0.0], [2.0],
    [1 + 1e-9, 1.0, 1 - 1e-9, 0.1]])
def test_spectrum_of_known_matrices(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((d, d)))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    got, vectors = whitening.spectrum(a, d)
    assert got == pytest.approx(sorted(values, reverse=True), abs=1e-12 * max(values))
    assert vectors.T @ vectors == pytest.approx(np.eye(d), abs=1e-12)
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-12 * max(values)


def test_spectrum_of_random_covariance():
    x = np.random.default_rng(2).standard_normal((500, 64))
    a = np.cov(x.T)
    want, axes = np.linalg.eigh(a)
    got, vectors = whitening.spectrum(a, 4)
    assert got == pytest.approx(want[::-1][:4], rel=1e-13)
    assert np.abs(np.sum(vectors * axes[:, ::-1][:, :4], axis=0)) == pytest.approx(1, abs=1e-12)


def test_polar_factor_of_a_singular_shift():
    u = whitening.qdwh(np.diag([2.0, 1e-9, -3.0]))
    assert u == pytest.approx(np.diag([1.0, 1.0, -1.0]), abs=1e-9)


def test_odd_tables(spark):
    assert whitening.whiten(_table(spark, [])).collect() == []
    assert whitening.whiten(_table(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(_table(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [
        (i, k, 1, 0, 0.0, 0.0) for i in (1, 2) for k in (1, 2)]
    line = whitening.whiten(_table(spark, [(i, [float(i), 1.0]) for i in range(5)])).collect()
    assert {r.component: round(r.explained, 12) for r in line} == {1: 1.0, 2: 0.0}
    assert all(r.identity_error < 1e-12 for r in line)


def test_huge_entries_stay_exact(spark):
    rows = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1.0, 3.0])]
    got = whitening.whiten(_table(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} or len(got) == 6
    rows = [(i, [2.0 ** 40 * i, 0.25 * i * i]) for i in range(4)]
    got = [r for r in whitening.whiten(_table(spark, rows)).collect() if r.component == 1]
    x = [(math.floor(256 * 2.0 ** 40 * i), math.floor(64 * i * i)) for i in range(4)]
    s = [sum(c) for c in zip(*x)]
    want = [sum((4 * c - t) ** 2 for c, t in zip(v, s)) for v in x]
    assert [r.deviation for r in sorted(got, key=lambda r: r.vec_id)] == [w if w < 2**63 else None for w in want]


def test_result_does_not_depend_on_partitions(spark):
    rows = list(enumerate(_vectors(400, 8, seed=9)))
    first, second = (sorted(map(tuple, whitening.whiten(_table(spark, rows).repartition(k)).drop("identity_error").collect()))
                     for k in (1, 9))
    assert [r[:4] + r[5:] for r in first] == [r[:4] + r[5:] for r in second]
    assert [r[4] for r in first] == pytest.approx([r[4] for r in second], abs=1e-13)  # BLAS rounds by a row's place
