"""Whitening of embeddings."""

import collections
import math

import numpy as np
import pytest

from kelpline.llm import whitening


def plain(rows, most=32):
    """The result by numpy's own eigenvalues and whole numbers of any size: {(row, component): (deviation, whitened, explained)}."""
    xs = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    scaled = [[n * v - s for v, s in zip(x, sums)] for x in xs]
    centred = np.array([[v / n for v in row] for row in scaled])
    matrix = centred.T @ centred / n
    values, columns = np.linalg.eigh(matrix)
    values, columns = values[::-1], columns[:, ::-1]
    out = {}
    for r, (i, _) in enumerate(rows):
        for k in range(min(most, d)):
            if values[k] > d * 1e-15 * values[0]:
                out[r, k + 1] = (i, n, sum(v * v for v in scaled[r]), centred[r] @ columns[:, k] / math.sqrt(values[k]), values[k] / values.sum())
    return out


def same(found, rows, close=1e-9):
    """Rows in the order of ``rows``; components of either sign."""
    expected = plain(rows)
    order = {i: r for r, (i, _) in enumerate(rows)}
    got = {(order[f.vec_id], f.component): f for f in found}
    assert len(found) == len(got) and set(got) == set(expected)
    signs = collections.defaultdict(set)
    for (r, k), (i, n, deviation, white, explained) in expected.items():
        f = got[r, k]
        assert (f.vec_id, f.n, f.deviation) == (i, n, deviation)
        assert f.explained == pytest.approx(explained, rel=1e-9) and f.identity_error < 1e-9
        assert abs(abs(f.whitened) - abs(white)) < close
        if abs(white) > 1e-6:
            signs[k].add(f.whitened * white > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    same(whitening.whiten(df.repartition(5)).collect(), rows, 1e-7)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    odd = [(50, None), (51, []), (52, [None, 1.0, 1.0, 1.0, 1.0]), (53, [float("nan")] * 5), (54, [float("inf")] + [0.0] * 4), (55, [1.0] * 3)]
    extra = [(None, good[0][1]), (None, good[0][1]), (3, good[7][1]), (3, good[3][1])]
    schema = "vec_id long, embedding array<double>, n string, vec string, _none string, component string"
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in good + odd + extra], schema).repartition(4)
    found = whitening.whiten(df).collect()
    expected = plain(good + extra)
    assert len(found) == len(expected) == 44 * 5
    assert sorted((f.deviation, f.component) for f in found) == sorted((v[2], k) for (_, k), v in expected.items())
    # both rows without an id, and all three of id 3, have rows of their own
    assert collections.Counter(f.vec_id for f in found if f.component == 1)[None] == 2
    assert collections.Counter(f.vec_id for f in found if f.component == 1)[3] == 3
    for f in found:
        assert min(abs(abs(f.whitened) - abs(v[3])) for v in expected.values() if v[0] == f.vec_id and v[2] == f.deviation) < 1e-9


def test_what_does_not_vary(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], schema)).count() == 0
    # one of three dimensions varies, one repeats it, one is constant
    rows = [(i, [float(i), float(i), 7.0]) for i in range(9)]
    found = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert {f.component for f in found} == {1} and found[0].explained == pytest.approx(1.0)
    same(found, rows)


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(3) * 1e4 + 1e9).tolist()) for i in range(50)]
    same(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), rows)
    wide = [(i, (rng.standard_normal(3) * 1e9).tolist()) for i in range(30)]
    found = whitening.whiten(spark.createDataFrame(wide + [(30, [1e300, -1e300, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert len(found) == 31 * 3 and all(f.deviation is None and f.identity_error < 1e-6 for f in found)


def test_sums_of_products():
    rng = np.random.default_rng(6)
    for top in (3, 2**19, 2**21, 2**40, 2**53):
        y = rng.integers(-top, top, (40, 3))
        total = {}
        whitening.products(y, total)
        wide = y.astype(object)
        exact = wide.T @ wide
        for i in range(3):
            for j in range(3):
                assert sum(int(m[i, j]) << (whitening.LIMB * w) for w, m in total.items()) == exact[i, j]


@pytest.mark.parametrize("kind", ["random", "few", "equal", "falling", "zero", "one"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(7)
    n = 48
    turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
    values = {
        "random": np.sort(rng.random(n))[::-1], "few": np.r_[np.arange(6, 0, -1.0), np.zeros(n - 6)], "equal": np.repeat([4.0, 2.0, 1.0], n // 3),
        "falling": 10.0 ** -(np.arange(n) / 4), "zero": np.zeros(n), "one": np.ones(n),
    }[kind]
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    found, columns = whitening.eigen(a)
    assert np.abs(found - values).max() < 1e-13 and (np.diff(found) <= 0).all()
    assert np.abs(columns.T @ columns - np.eye(n)).max() < 1e-12
    assert np.abs(a @ columns - columns * found).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(8)
    for n in (1, 2, 9, 40):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values, columns = np.linalg.eigh(a)
        assert np.abs(whitening.polar_factor(a) - (columns * np.sign(values)) @ columns.T).max() < 1e-11
