"""Whitening: polynomial, roots and null spaces against exact and floating-point versions; the query by brute force."""
import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from cartwheel.llm import whitening as W
from cartwheel.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def scatter_of(x):
    """Integer n * sum(x x') - S S' of rows ``x``, in Python integers."""
    x = [[int(c) for c in r] for r in x]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]


def plain_charpoly(m):
    """Faddeev-LeVerrier in fractions, constant coefficient first."""
    d = len(m)
    a = np.array([[Fraction(c) for c in r] for r in m], object)
    c, b = [Fraction(1)], np.array([[Fraction(0)] * d for _ in range(d)], object)
    one = np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
    for k in range(1, d + 1):
        b = a @ b + c[-1] * one
        c.append(-Fraction(1, k) * (a @ b).trace())
    return [int(v) for v in reversed(c)]


def test_primes():
    got = W.primes_below(1000, 500)
    assert got == [p for p in range(999, 1, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    top = W.primes_below(1 << 31, 3)
    assert top == [2147483647, 2147483629, 2147483587]


@pytest.mark.parametrize(("n", "d"), [(6, 1), (9, 2), (12, 5), (4, 6), (30, 9)])
def test_polynomial(spark, n, d):
    m = scatter_of(np.random.default_rng(n).integers(-50, 50, (n, d)))
    assert W.charpoly(spark, m) == plain_charpoly(m)


def test_polynomial_with_empty_pivots(spark):
    m = [[2, 0, 0, 0], [0, 3, 0, 0], [0, 0, 3, 1], [0, 0, 1, 3]]
    assert W.charpoly(spark, m) == plain_charpoly(m)


def test_roots_and_spaces(spark):
    m = [[4, 0, 0, 0, 0], [0, 3, 1, 0, 0], [0, 1, 3, 0, 0], [0, 0, 0, 0, 0], [0, 0, 0, 0, 4]]  # 4 three times, 2, 0
    roots = W.Roots(W.charpoly(spark, m), 14)
    assert roots.rank == 4
    for k, (value, first, size) in enumerate([(4, 1, 3), (4, 1, 3), (4, 1, 3), (2, 4, 1)], 1):
        at, f, s = roots.find(k)
        assert (f, s) == (first, size) and abs(Fraction(at, 1 << roots.shift) - value) <= Fraction(1, 1 << roots.shift)
    basis = W.null_space(m, Decimal(roots.find(2)[0]) / (1 << roots.shift), 3).astype(float)
    assert np.allclose(basis @ basis.T, np.eye(3), atol=1e-15) and np.allclose(np.array(m) @ basis.T, 4 * basis.T, atol=1e-15)


def test_close_roots(spark):
    """Eigenvalues that differ by 1e-15 of their size: doubles would mix the two components."""
    big = 10 ** 15
    m = [[big + 1, 0, 0], [0, big, 0], [0, 0, 5]]
    roots = W.Roots(W.charpoly(spark, m), 2 * big + 6)
    for k, (value, axis) in enumerate([(big + 1, 0), (big, 1), (5, 2)], 1):
        at, first, size = roots.find(k)
        assert (first, size) == (k, 1) and abs(Fraction(at, 1 << roots.shift) - value) < Fraction(1, 1 << 60)
        v = W.null_space(m, Decimal(at) / (1 << roots.shift), 1)[0].astype(float)
        assert abs(v[axis]) > 1 - 1e-15


def test_products_are_exact():
    rnd = np.random.default_rng(4)
    y = rnd.integers(-(1 << 62), 1 << 62, (5000, 3))
    got = W._products(y)
    z = [[int(c) for c in r] + [1] for r in y]
    assert got.tolist() == [[sum(r[i] * r[j] for r in z) for j in range(4)] for i in range(4)]


def brute(rows, most):
    """{id: (deviation, whitened)} of valid (id, vector), explained."""
    ids = [r[0] for r in rows]
    x = np.floor(64 * np.array([r[1] for r in rows], float))
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-9).sum()))
    whole = [[int(v) for v in r] for r in x]
    s = [sum(r[j] for r in whole) for j in range(len(whole[0]))]
    dev = [sum((len(whole) * r[j] - s[j]) ** 2 for j in range(len(s))) for r in whole]
    return ids, dev, c @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def compare(got, rows, most=32):
    ids, dev, white, explained = brute(rows, most)
    k = white.shape[1]
    assert len(got) == len(rows) * k
    table = {(r["vec_id"], r["component"]): r for r in got}
    mine = np.array([[table[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-8
    assert [table[i, 1]["deviation"] for i in ids] == dev
    assert np.allclose([table[ids[0], c + 1]["explained"] for c in range(k)], explained, rtol=1e-9)
    assert all(r["n"] == len(rows) and r["identity_error"] < 1e-9 for r in got)


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    compare(QUERIES["op11_embedding_whitening"](spark, SF).collect(), rows)


def test_odd_rows(spark):
    rnd = np.random.default_rng(1)
    good = [(k, rnd.normal(0, 1, 3).tolist()) for k in range(40)] + [(None, [0.5, 0.5, 0.5])]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [1.0] * 4)]
    shape = "vec_id long, embedding array<double>, v int, id int, component string"
    vectors = spark.createDataFrame([(*r, 1, 2, "x") for r in good + bad], shape).repartition(4)
    compare(W.whiten(vectors, most=2).collect(), good, most=2)
    flat = spark.createDataFrame([(k, [1.0, 2.0, float(k % 2)], 1, 2, "x") for k in range(10)], shape)   # rank 1
    assert {r["component"] for r in W.whiten(flat).collect()} == {1}
    for none in (flat.limit(0), flat.limit(1), flat.where("vec_id % 2 = 0"), vectors.where("vec_id = 100")):
        assert W.whiten(none).count() == 0
    twice = flat.unionAll(flat)
    assert W.whiten(twice).count() == 20


def test_large_entries(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 3.0]), (3, [float(1 << 40), 5.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[max(-(1 << 62), min(1 << 62, math.floor(64 * Fraction(c)))) for c in r[1]] for r in rows]
    s = [sum(r[j] for r in x) for j in range(2)]
    for r in got:
        want = sum((4 * x[r["vec_id"]][j] - s[j]) ** 2 for j in range(2))
        assert (r["deviation"] if r["deviation"] is not None else int(r["deviation_digits"])) == want
        assert r["identity_error"] < 1e-4 and math.isfinite(r["whitened"])
