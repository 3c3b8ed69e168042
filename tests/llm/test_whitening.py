"""Whitening against whole-number algebra and a library's eigenvectors."""

import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelmetrics.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"


def faddeev_leverrier(matrix):
    """Coefficients, lowest power first, of det(x * I - matrix), in whole numbers."""
    d = len(matrix)
    a = np.array(matrix, object)
    m, out = np.zeros((d, d), object), [1]
    for k in range(1, d + 1):
        m = a.dot(m) + out[-1] * np.array([[int(i == j) for j in range(d)] for i in range(d)], object)
        out.append(-int(a.dot(m).trace()) // k)
    return out[::-1]


def semidefinite(rng, d, rank, size):
    x = rng.integers(-size, size, (rank, d)).astype(object)
    return x.T.dot(x)


MATRICES = [semidefinite(np.random.default_rng(k), d, rank, size) for k, (d, rank, size) in
            enumerate([(1, 1, 9), (2, 2, 9), (6, 9, 10), (8, 3, 100), (12, 20, 10 ** 12)])] \
    + [np.diag(np.array([9, 4, 9, 0, 1], object)), np.array([[2, 0, 0], [0, 5, 3], [0, 3, 5]], object), np.zeros((3, 3), object)]


@pytest.mark.parametrize("matrix", MATRICES, ids=range(len(MATRICES)))
def test_polynomial_is_exact(spark, matrix):
    assert whitening.polynomial(spark, matrix) == faddeev_leverrier(matrix)


@pytest.mark.parametrize("matrix", MATRICES, ids=range(len(MATRICES)))
def test_roots_and_null_vectors(matrix):
    roots = whitening.largest_roots(faddeev_leverrier(matrix), int(matrix.trace()), 4)
    want = np.linalg.eigvalsh(matrix.astype(float))[::-1]
    want = [x for x in want if x > 1e-9 * max(1, want[0])][:4]
    assert np.allclose([m / 2 ** s for m, s, _ in roots], want, rtol=1e-9)
    for group in {g for *_, g in roots}:
        m, s, _ = next(r for r in roots if r[2] == group)
        found = np.array(whitening.null_vectors(matrix.tolist(), m, s, sum(r[2] == group for r in roots)))
        assert np.allclose(found @ found.T, np.eye(len(found)), atol=1e-14)
        assert np.allclose(matrix.astype(float) @ found.T, (m / 2 ** s) * found.T, atol=1e-12 * float(matrix.trace()))


def test_equal_and_close_roots():
    matrix = np.diag(np.array([10 ** 20, 10 ** 20 - 1, 7, 7, 7, 1], object))
    roots = whitening.largest_roots(faddeev_leverrier(matrix), int(matrix.trace()), 4)
    assert [g for *_, g in roots] == [0, 1, 2, 2]
    assert [abs(Decimal(m) / 2 ** s - w) < Decimal(10) ** -20 for (m, s, _), w in zip(roots, [10 ** 20, 10 ** 20 - 1, 7, 7])] == [True] * 4
    first = whitening.null_vectors(matrix.tolist(), roots[0][0], roots[0][1], 1)
    assert np.allclose(first, [[1, 0, 0, 0, 0, 0]], atol=1e-30)


def test_products_of_any_size():
    rng = np.random.default_rng(2)
    for bits in (3, 15, 16, 31, 40, 62):
        x = rng.integers(-2 ** bits, 2 ** bits, (7, 3))
        assert (whitening.products(x) == x.astype(object).T.dot(x.astype(object))).all()


def plain(rows, components=4):
    """{(vec_id, component): (n, deviation, whitened, explained)} with numpy's eigenvectors."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in kept]
    x = np.array(sorted({v for _, v in whole}), object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    cov = (centred.T.dot(centred) // n).astype(float) / n / n
    values, vectors = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values) if values[k] > 1e-9 * values.max()][:components]
    out = []
    for i, v in whole:
        c = n * np.array(v, object) - sums
        w = (c / n).astype(float) @ vectors[:, order] / np.sqrt(values[order])
        out += [(i, k + 1, n, int((c * c).sum()), w[k], values[o] / values.sum()) for k, o in enumerate(order)]
    return out


def same(df, rows, components=4, distinct=True):
    got = df.collect()
    want = plain(rows, components)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got = sorted([(r.vec_id, r.component, r.n, int(r.deviation_digits), r.whitened, r.explained, r.deviation, r.identity_error) for r in got], key=key)
    want = sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(g[6] == (g[3] if g[3] < 2 ** 63 else None) for g in got)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-4)
    assert len({g[7] for g in got}) == 1 and got[0][7] < 1e-9
    if distinct:
        for k in range(1, components + 1):
            a, b = (np.array([r[4] for r in side if r[1] == k]) for side in (got, want))
            assert min(abs(a - b).max(), abs(a + b).max()) < 1e-6


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    same(queries.op11_embedding_whitening(spark, SF_DIR), rows)


SCHEMA = "vec_id long, embedding array<double>, x int, component string"
ODD = [(1, [1.0, 2.0, 3.0]), (2, None), (3, []), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]),
       (7, [0.0, -0.0, 0.0]), (8, [-1.5, 0.25, 9.0]), (8, [-1.5, 0.25, 9.0]), (None, [2.0, 2.0, -7.0]), (9, [1.0, 2.001, 3.0]), (10, [300.0, -400.0, 5.0])]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c") for r in rows], SCHEMA)


def test_odd_rows(spark):
    same(whitening.whiten(frame(spark, ODD).repartition(3)), ODD, 3)
    other = ODD + [(20, [1.0, 2.0]), (21, [2e16 * 4] * 3)]  # another dimension, and a number that is no long
    same(whitening.whiten(frame(spark, other)), ODD, 3)


def test_numbers_beyond_longs(spark):
    rows = [(k, [float(a), float(b)]) for k, (a, b) in enumerate([(1e14, 2e13), (-3e14, 5), (7e12, 1e14), (0, 0)])]
    same(whitening.whiten(frame(spark, rows)), rows, 2)


def test_equal_eigenvalues(spark):
    rows = [(k, [1.0 if j == k // 2 else 0.0 for j in range(5)] if k % 2 else [-1.0 if j == k // 2 else 0.0 for j in range(5)]) for k in range(10)]
    out = whitening.whiten(frame(spark, rows))
    same(out, rows, 4, distinct=False)
    # Any basis of equal eigenvalues: the same for all rows, so opposite vectors stay opposite.
    got = {(r.vec_id, r.component): r.whitened for r in out.collect()}
    assert all(abs(got[2 * k, c] + got[2 * k + 1, c]) < 1e-9 for k in range(5) for c in range(1, 5))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])] * 3], ids=["empty", "nulls", "alike"])
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(frame(spark, rows))
    assert out.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0
