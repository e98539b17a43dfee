from fractions import Fraction

import numpy as np
import pytest

from corridor.llm import charpoly, whitening
from corridor.llm.queries import op12_whitening
from tests.conftest import SF_SMALL

VECS = "vec_id long, embedding array<double>, component string, n int"


def matrix_of(y):
    y = np.array(y, object)
    return len(y) * (y.T @ y) - np.outer(y.sum(axis=0), y.sum(axis=0))


def polynomial(m):
    primes = charpoly.enough_primes(m)
    return charpoly.remaindered(charpoly.modular_polynomials(m, primes), primes)


def faddeev(m):
    """The characteristic polynomial over the rationals, by another method (Faddeev and LeVerrier)."""
    d, out, b = len(m), [1], np.eye(len(m), dtype=int).astype(object)
    for k in range(1, d + 1):
        mb = m @ b
        c = -sum(mb[i, i] for i in range(d)) // k
        out.append(c)
        b = mb + c * np.eye(d, dtype=int).astype(object)
    return out[::-1]


@pytest.mark.parametrize("shape, top", [((30, 9), 40), ((5, 8), 3), ((12, 3), 2**60), ((9, 1), 5), ((4, 6), 1)])
def test_polynomial_is_exact(shape, top):
    m = matrix_of(np.random.default_rng(3).integers(-top, top + 1, shape))
    assert polynomial(m) == faddeev(m)


def test_roots_and_vectors_agree_with_floating_point():
    m = matrix_of(np.random.default_rng(0).integers(-30, 31, (300, 24)))
    roots = charpoly.largest_roots(polynomial(m), 10)
    values, vectors = np.linalg.eigh(m.astype(float))
    assert np.allclose([float(r) for r, _ in roots], values[::-1][:10], rtol=1e-12)
    for k, (r, times) in enumerate(roots):
        v = charpoly.null_vectors(m, r, times)[0]
        assert abs(abs(v @ vectors[:, -1 - k]) - 1) < 1e-9


def test_close_and_equal_roots():
    e = np.eye(5, dtype=int)
    m = matrix_of(np.concatenate([e, -e]))
    assert charpoly.largest_roots(polynomial(m), 3) == [(charpoly.largest_roots(polynomial(m), 3)[0][0], 5)]
    basis = charpoly.null_vectors(m, charpoly.largest_roots(polynomial(m), 1)[0][0], 5)
    assert np.abs(basis @ basis.T - np.eye(5)).max() < 1e-12
    # Eigenvalues 10^15 and 10^15 + 1: doubles hardly tell them apart, their vectors are exact here.
    close = np.array([[10**15, 0, 0], [0, 10**15 + 1, 0], [0, 0, 5]], object)
    (a, one), (b, other) = charpoly.largest_roots(polynomial(close), 2)
    assert one == other == 1 and abs(a - (10**15 + 1)) < Fraction(1, 10**9) and abs(b - 10**15) < Fraction(1, 10**9)
    assert np.allclose(charpoly.null_vectors(close, a, 1), [[0, 1, 0]]) and np.allclose(charpoly.null_vectors(close, b, 1), [[1, 0, 0]])


@pytest.mark.parametrize("top", [10, 2**30, 2**61])
def test_gram_is_exact(top):
    y = np.random.default_rng(1).integers(-top, top, (40, 5))
    assert (whitening.exact_gram(y) == y.astype(object).T @ y.astype(object)).all()


def expected(vectors, count=32):
    x = np.floor(64 * np.array(vectors)) + 1_000_000
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    order = [i for i in np.argsort(-values) if values[i] > 1e-9 * values.max()][:count]
    return (x - x.mean(axis=0)) @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_query_equals_floating_point(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas().sort_values("vec_id")
    vectors = np.stack(table.embedding.to_list()).astype(float)
    want, share = expected(vectors)
    got = op12_whitening(spark, SF_SMALL).toPandas()
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert w.shape == want.shape and (got.n == len(vectors)).all()
    assert np.abs(w - want * np.sign((w * want).sum(axis=0))).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    x = np.floor(64 * vectors).astype(int) + 1_000_000
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert got.groupby("vec_id").deviation.first().to_list() == deviation.tolist()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), float(i % 4), 1.0], "x", 7) for i in range(12)]
    bad = [(100, None, "x", 7), (101, [], "x", 7), (102, [1.0, None, 2.0], "x", 7), (103, [nan, 1.0, 1.0], "x", 7),
           (104, [1.0, -inf, 1.0], "x", 7), (105, [1.0, 2.0], "x", 7)]
    rows = good + bad + [good[0], (None, [2.0, 3.0, 1.0], "x", 7)]
    got = whitening.whiten(spark.createDataFrame(rows, VECS)).toPandas()
    assert sorted(got.component.unique()) == [1, 2] and set(got.n) == {14} and len(got) == 28     # the third entry is constant
    want, _ = expected([r[1] for r in good] + [good[0][1], [2.0, 3.0, 1.0]])
    w = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened")
    assert np.allclose(np.abs(w.to_numpy()), np.abs(want[:12])) and got.identity_error.max() < 1e-9
    for none in ([], good[:1], [good[0]] * 3, bad[:5]):
        assert whitening.whiten(spark.createDataFrame(none, VECS)).count() == 0
    huge = [(i, [1e300 * (-1) ** i, float(i)], "x", 1) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(huge, VECS)).toPandas()
    assert got.deviation.isna().all() and got.identity_error.max() < 1e-4 and len(got) == 12
