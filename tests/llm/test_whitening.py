import math
from fractions import Fraction

import numpy as np
import pytest

from brothlake.llm import doubled, whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, at int"


def brute_force(vectors):
    """n, sums, deviations and the exact covariance of the rows that take part."""
    x = [[math.floor(1024 * Fraction(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    deviations = [sum(c * c for c in r) for r in centred]
    covariance = [[Fraction(sum(r[i] * r[j] for r in centred), n**3) for j in range(d)] for i in range(d)]
    return n, sums, deviations, centred, covariance


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", "y", 0) for i, v in rows], SCHEMA).repartition(parts)


def held(spark, rows, vectors, least=1e-12, ids=None):
    """whitened() against exact arithmetic: every column, orthonormal eigenvectors by their residuals, and the covariance of what is returned."""
    got = whitening.whitened(frame(spark, rows)).collect()
    n, sums, deviations, centred, covariance = brute_force(vectors)
    d = len(sums)
    fit = whitening.fitted(frame(spark, rows).withColumnRenamed("embedding", "v"))
    assert (fit.n, fit.sums) == (n, sums)
    trace = sum(covariance[i][i] for i in range(d))
    k = min(8, d)
    for c in range(k):
        u = [Fraction(fit.vectors[0][i, c]) + Fraction(fit.vectors[1][i, c]) for i in range(d)]
        off = [sum(covariance[i][j] * u[j] for j in range(d)) - Fraction(float(fit.values[c])) * u[i] for i in range(d)]
        assert math.sqrt(sum(float(o) ** 2 for o in off)) <= least * float(fit.values[c])
        assert abs(sum(a * a for a in u) - 1) < 1e-15
    assert list(fit.values) == sorted(fit.values, reverse=True)
    assert len(got) == n * k and {(r.n, r.identity_error) for r in got} == {(n, got[0].identity_error)} and got[0].identity_error < 1e-8
    assert sorted(int(r.deviation) for r in got if r.component == 1) == sorted(deviations)
    white = {}
    for r in got:
        assert abs(r.explained - float(fit.values[r.component - 1]) / float(trace)) <= 1e-12 * r.explained
        white.setdefault((r.component), []).append((r.vec_id if r.vec_id is not None else -1, r.whitened))
    for c in range(k):
        u = [Fraction(fit.vectors[0][i, c]) + Fraction(fit.vectors[1][i, c]) for i in range(d)]
        want = [float(sum(a * b for a, b in zip(row, u)) / n) / math.sqrt(fit.values[c]) for row in centred]
        np.testing.assert_allclose([w for _, w in sorted(white[c + 1])], [w for _, w in sorted(zip([i if i is not None else -1 for i in ids or range(n)], want))], rtol=1e-9, atol=1e-9)
    return got


def test_equals_exact_arithmetic(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(90, 10)) @ rng.normal(size=(10, 10))).tolist()
    held(spark, list(enumerate(x)), x)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 3)).tolist()
    odd = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [1.0, float("inf"), 0.0]), (6, [1.0, 2.0]), (7, [1e300, 0.0, 0.0])]
    held(spark, list(enumerate(x)) + odd, x)


def test_null_ids_and_repeated_rows(spark):
    x = [[1.0, 2.0], [1.5, -2.0], [0.0, 0.25], [0.0, 0.25], [3.0, 1.0]]
    got = held(spark, [(None, x[0]), (1, x[1]), (2, x[2]), (2, x[3]), (3, x[4])], x, ids=[None, 1, 2, 2, 3])
    assert sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 2 for r in got) == 4


def test_far_apart_variances(spark):
    """One dimension varies 10^11 times as much as others, far from zero: beyond what doubles can tell."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 9)) * np.array([1e11, 1e6, 1e3, 1, 1, 1, 1, 1, 1]) + np.array([3e12] + [0] * 8)
    x[:, 0] = np.round(x[:, 0])
    turned = np.linalg.qr(rng.normal(size=(9, 9)))[0]
    for v in (x, x @ turned):
        held(spark, list(enumerate(v.tolist())), v.tolist(), least=1e-9)


def test_no_variance(spark):
    rows = [(i, [1.0, 2.0, float(i)]) for i in range(5)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {(r.component, r.whitened is None, round(r.explained, 9)) for r in got} == {(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)}
    assert got[0].identity_error < 1e-12
    got = whitening.whitened(frame(spark, [(1, [1.0]), (2, [1.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(2, 0, None, None, None)] * 2
    assert whitening.whitened(frame(spark, rows).where("false")).count() == 0


def test_wide_deviations(spark):
    """Squares of 64 bits and more are exact; beyond 38 digits they are null, not wrong."""
    x = [[0.0, 1.0], [2.0**40, 0.0], [-(2.0**41), 5.0]]
    _, _, want, _, _ = brute_force(x)
    got = whitening.whitened(frame(spark, list(enumerate(x)))).where("component = 1").orderBy("vec_id").collect()
    assert [int(r.deviation) for r in got] == want and max(want) > 2**63
    x = [[2.0**51], [-(2.0**51)]] * 10
    got = whitening.whitened(frame(spark, list(enumerate(x)))).collect()
    assert all(r.deviation is None or int(r.deviation) == w for r, w in zip(got, brute_force(x)[2])) and len(got) == 20


def test_query(spark):
    got = whitening.query(spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    rows = got.collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    n, _, deviations, _, _ = brute_force([r.embedding for r in table])
    assert len(rows) == 8 * n and sorted(r.deviation for r in rows) == sorted(8 * deviations) and rows[0].identity_error < 1e-9
    white = np.zeros((n, 8))
    place = {r.vec_id: i for i, r in enumerate(table)}
    for r in rows:
        white[place[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(np.cov(white.T, bias=True) - np.eye(8)).max() < 1e-9


def test_products_are_exact():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(5, 40)) * 10.0 ** rng.integers(-6, 6, (5, 1)), rng.normal(size=(40, 3))
    low = a * 1e-17
    got = doubled.product((a, low), doubled.pair(b))
    for i in range(5):
        for j in range(3):
            want = sum((Fraction(a[i, k]) + Fraction(low[i, k])) * Fraction(b[k, j]) for k in range(40))
            assert abs(Fraction(got[0][i, j]) + Fraction(got[1][i, j]) - want) < Fraction(2) ** -95 * Fraction(np.abs(a[i]).max())


@pytest.mark.parametrize("values", [np.ones(7), np.array([1, 1 + 1e-12, 1 + 2e-12, 1e-8, 1.0001e-8, 5, 6]), 10.0 ** -np.arange(0, 14, 2), np.zeros(7)])
def test_eigenvectors_of_close_and_graded_values(values):
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(7, 7)))[0]
    m = (q * values @ q.T + (q * values @ q.T).T) / 2
    got, (high, low) = doubled.eigen(doubled.pair(m))
    for k in range(7):
        u = [Fraction(a) + Fraction(b) for a, b in zip(high[:, k], low[:, k])]
        off = [float(sum(Fraction(m[i, j]) * u[j] for j in range(7)) - Fraction(got[k]) * u[i]) for i in range(7)]
        assert np.linalg.norm(off) <= 1e-13 * abs(got[k]) + 1e-28
