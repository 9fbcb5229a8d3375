"""Eigenvectors against numpy's, the report against a plain computation, odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from refreshguard.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, whitened string"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, "c", "w") for i, v in vectors], SCHEMA)


def matrices():
    random = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 9, 40, 100):
        a = random.standard_normal((n, n))
        yield a @ a.T
        yield np.eye(n)
        yield np.zeros((n, n))
        q, _ = np.linalg.qr(random.standard_normal((n, n)))
        for values in (np.where(np.arange(n) < n // 2, 5.0, 1.0), 0.5 ** np.arange(n),
                       1 + 1e-9 * np.arange(n)):
            b = q @ np.diag(values) @ q.T
            yield (b + b.T) / 2
        yield np.outer(q[0], q[0])


def test_eigenvectors():
    for a in matrices():
        values, vectors = whitening.eigenvectors(a)
        size = max(1.0, np.abs(a).max())
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:8]).max() < 1e-13 * size * len(a)
        assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-13 * size * len(a)
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12


def test_sturm_counts():
    random = np.random.default_rng(6)
    d, e = random.standard_normal(30), random.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    points = np.linspace(-4, 4, 50)
    assert (whitening.below(d, e * e, points) == (values[:, None] < points).sum(axis=0)).all()


def plain(vectors):
    """The contract, word for word, on one machine."""
    good = [(i, v) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    a = np.array(x, dtype=float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(values)[::-1][:8]
    whitened = a @ vectors[:, order] / np.sqrt(values[order])
    return [i for i, _ in good], n, deviations, whitened, values[order] / values.sum()


@pytest.mark.parametrize("dims,rows", [(3, 40), (20, 300)])
def test_report(spark, dims, rows):
    random = np.random.default_rng(dims)
    scale = 1 + np.arange(dims)
    vectors = [(i, (random.standard_normal(dims) * scale / dims).tolist()) for i in range(rows)]
    vectors += [(900, None), (901, [None] * dims), (902, [math.nan] * dims),
                (903, [math.inf] + [0.0] * (dims - 1)), (904, [0.0] * dims), (7, vectors[7][1])]
    ids, n, deviations, expected, shares = plain(vectors)
    found = whitening.whitening_report(make(spark, vectors).repartition(5)).collect()
    k = min(8, dims)
    assert len(found) == len(ids) * k and {r["n"] for r in found} == {n}
    assert sorted(r["vec_id"] for r in found) == sorted(ids * k)
    at = {i: j for j, i in enumerate(ids)}
    signs = {}
    for r in found:
        c, row = r["component"] - 1, at[r["vec_id"]]
        assert r["deviation"] == deviations[row]
        assert r["explained"] == pytest.approx(shares[c], rel=1e-9)
        assert abs(r["whitened"]) == pytest.approx(abs(expected[row, c]), abs=1e-8)
        if abs(expected[row, c]) > 1e-3:
            signs.setdefault(c, set()).add(np.sign(r["whitened"] * expected[row, c]))
    assert all(len(s) == 1 for s in signs.values())
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_same_result_however_dealt_out(spark):
    random = np.random.default_rng(9)
    frame = make(spark, [(i, random.standard_normal(6).tolist()) for i in range(200)])
    fits = [whitening.fit(whitening.usable(frame.repartition(p))) for p in (1, 7)]
    assert (fits[0].vectors == fits[1].vectors).all() and (fits[0].values == fits[1].values).all()


def test_odd_vectors(spark):
    nothing = make(spark, []).limit(0)
    assert whitening.whitening_report(nothing).count() == 0
    # Equal vectors, and a single one, have no component with a positive eigenvalue.
    assert whitening.whitening_report(make(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whitening_report(make(spark, [(1, []), (2, [])])).count() == 0
    # A short vector is followed by zeros, a null id stays, huge entries are left out.
    rows = whitening.whitening_report(make(spark, [
        (1, [1.0]), (None, [1.0, 1.0]), (2, [0.0, -1.0]), (3, [1e30, 0.0])])).collect()
    same = whitening.whitening_report(make(spark, [
        (1, [1.0, 0.0]), (None, [1.0, 1.0]), (2, [0.0, -1.0])])).collect()
    assert sorted(map(str, rows)) == sorted(map(str, same)) and {r["n"] for r in rows} == {3}
    assert len(rows) == 6


def test_products_are_exact():
    y = np.array([[3_000_000_000, -1], [2_999_999_999, 5]])
    found = whitening._exact_products(y)
    assert found[0][0] == 3_000_000_000 ** 2 + 2_999_999_999 ** 2
    small = np.random.default_rng(1).integers(-1000, 1000, (5000, 4))
    assert (whitening._exact_products(small) == small.T @ small).all()
