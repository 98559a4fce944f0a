"""Bit-sliced whitening against plain covariance models."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tokenmill.llm import whitening as W

EXTRA = "vec_id long, embedding array<double>, x long, n long, component string, c double"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, 2, "c", 0.5) for i, v in zip(ids, vectors, strict=True)], EXTRA)


def model(vectors):
    """(rows, fit list, exact sums, exact covariance as fractions) of whole vectors."""
    rows = [[max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, rows)))
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    cov = [[Fraction(n * sum(x[a] * x[b] for x in fit) - sums[a] * sums[b], n * n) for b in range(width)] for a in range(width)]
    return rows, n, sums, cov


@pytest.mark.parametrize("low,high,width,count", [(-300, 300, 5, 7000), (0, 0, 3, 10), (-(1 << 62), 1 << 62, 4, 200),
                                                  (-5, -5, 2, 1), (1 << 40, (1 << 40) + 9, 6, 129)])
def test_scatter_is_exact(low, high, width, count):
    rng = random.Random(width)
    x = np.array([[rng.randint(low, high) for _ in range(width)] for _ in range(count)], np.int64)
    sums, cross = W.scatter(x)
    big = x.astype(object)
    assert sums.tolist() == big.sum(axis=0).tolist()
    assert cross.tolist() == (big.T @ big).tolist()


def test_limbs_add_up():
    for v in (0, 1, -1, 2**31, -2**31, 2**31 - 1, 2**126 + 12345, -(2**126) - 99, 2**64):
        assert sum(x << (W.LIMB * k) for k, x in W.limbs(v)) == v


def test_against_plain_covariance(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(7, 7)) * np.array([9, 5, 3, 2, 1, 0.5, 0.2])
    v = (rng.normal(size=(3000, 7)) @ mix.T + 40).tolist()
    v = v + v[:1500] + [v[0]] * 1500  # a third of the rows are one vector
    got = W.whiten(table(spark, v)).collect()
    rows, n, sums, cov = model(v)
    e, u = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == 4 * len(v)
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    whole = {}
    for r in got:
        x = rows[r["vec_id"]]
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) == int(r["deviation_digits"])
        k = r["component"] - 1
        want = (np.array(x) - np.array(sums) / n) @ u[:, k] / math.sqrt(e[k])
        whole.setdefault(k, []).append((want, r["whitened"]))
        assert math.isclose(r["explained"], e[k] / e.sum(), rel_tol=1e-9)
    for pairs in whole.values():  # either sign, the same for all rows
        a, b = np.array(pairs).T
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_scales_far_apart(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 6))
    v[:, 2] = v[:, 2] * 1e9 + 1e10
    got = W.whiten(table(spark, v.tolist())).collect()
    _, n, _, cov = model(v.tolist())
    assert got[0]["identity_error"] < 1e-4
    # next to so large a dimension the others are those of the covariance given that one
    keep = [0, 1, 3, 4, 5]
    rest = np.array([[float(cov[a][b] - cov[a][2] * cov[2][b] / cov[2][2]) for b in keep] for a in keep])
    want = np.linalg.eigvalsh(rest)[::-1][:3] / float(sum(cov[a][a] for a in range(6)))
    explained = sorted({(r["component"], r["explained"]) for r in got})
    assert np.allclose([x for _, x in explained][1:], want, rtol=1e-6)
    assert any(r["deviation"] is None and int(r["deviation_digits"]) >= 1 << 63 for r in got)


def test_odd_vectors(spark):
    v = [None, [1.0, None], [1.0, float("nan")], [float("inf"), 1.0], [1.0, 2.0], [], [1.0], [-0.0, 0.0], [1.0, 2.0],
         [1e300, 0.5], [3.0, -1.0]]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, None, 9, 4]
    got = W.whiten(table(spark, v, ids)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in got) == sorted(
        (i is None, i or 0) for i in [4, 5, 6, 7, None, 9, 4] for _ in (1, 2))
    assert {r["n"] for r in got} == {5}  # [] and [-0, 0] are one vector, the two [1, 2] as well
    same = W.whiten(table(spark, [[2.0, 3.0]] * 40)).collect()
    assert len(same) == 80 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {
        (1, 0, None, None, None)}
    assert W.whiten(table(spark, [[1.0], [2.0]])).count() == 2  # one dimension, one component
    empty = W.whiten(table(spark, []))
    assert empty.count() == 0 and empty.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_flat_directions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 2))
    v = [[a, a, b, 7.0] for a, b in base.tolist()]  # two directions of four
    got = W.whiten(table(spark, v)).collect()
    assert {r["component"] for r in got if r["whitened"] is None} == {3, 4}
    assert got[0]["identity_error"] < 1e-9
