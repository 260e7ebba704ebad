"""Whitening against exact integer covariances on small tables."""

import math

import numpy as np
import pytest

from lakespark.llm import queries, whiten


def brute(vectors, components=16):
    """Whitened rows (either sign), n, deviations and shares, from exact integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(v) for v in x})
    n, d = len(fit), len(fit[0])
    s = [sum(v[j] for v in fit) for j in range(d)]
    centred = [[n * v[j] - s[j] for j in range(d)] for v in fit]
    v = np.array([[sum(r[i] * r[j] for r in centred) / n**3 for j in range(d)] for i in range(d)])
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    k = min(components, d)
    rows = np.array([[(n * r[j] - s[j]) / n for j in range(d)] for r in x])
    white = rows @ w[:, :k] / np.sqrt(np.maximum(e[:k], 1e-300))
    return white, n, [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x], e[:k] / np.trace(v)


def check(rows, ids, vectors):
    white, n, deviation, share = brute(vectors)
    got = {}
    for r in rows:
        got[r.vec_id, r.component] = r
    assert len(got) == len(rows) == white.size
    sign = {}
    for i, v in enumerate(ids):
        for c in range(white.shape[1]):
            r = got[v, c + 1]
            assert (r.n, r.deviation) == (n, deviation[i])
            assert abs(r.explained - share[c]) <= 1e-9 * share[c]
            assert r.identity_error <= 1e-8
            if abs(white[i, c]) > 1e-3:
                sign.setdefault(c, np.sign(white[i, c] * r.whitened))
            assert abs(r.whitened * sign.get(c, 1) - white[i, c]) < 1e-7


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    check(queries.QUERIES["op13_whiten"](spark, sf).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.standard_normal(3) * (5, 1, 1e-1)]) for i in range(200)]
    again = [(1000 + i, v) for i, v in good[:50]] * 2
    odd = [(-1, None), (-2, [1.0, None, 2.0]), (-3, [float("nan"), 0.0, 0.0]), (-4, [float("inf"), 0.0, 0.0]), (-5, [1e300, 0.0, 0.0]), (-6, []), (-7, [1.0, 2.0])]
    df = spark.createDataFrame(good + again + odd, "vec_id long, embedding array<double>").selectExpr("*", "7 as x", "'a' as component", "1 as n")
    rows = whiten.whiten(df).collect()
    assert len(rows) == 3 * 300
    firsts = [r for r in rows if r.vec_id < 1000]
    check(firsts, [i for i, _ in good], [v for _, v in good])
    copies = {(r.vec_id, r.component, r.whitened) for r in rows if r.vec_id >= 1000}
    assert copies == {(r.vec_id + 1000, r.component, r.whitened) for r in firsts if r.vec_id < 50}


def test_null_key_and_float_entries(spark):
    df = spark.createDataFrame([(None, [0.5, 1.0]), (1, [1.5, -2.0]), (2, [0.25, 4.0]), (3, [9.0, 1.0])], "vec_id int, embedding array<float>")
    rows = whiten.whiten(df).collect()
    assert sorted((r.vec_id is None, r.component) for r in rows) == [(False, 1)] * 3 + [(False, 2)] * 3 + [(True, 1), (True, 2)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_without_variance(spark, rows):
    out = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_dependent_dimensions(spark):
    """A constant dimension and one that is the sum of two others carry no components of their own."""
    rng = np.random.default_rng(4)
    rows = [(i, [a, b, 3.0, a + b]) for i, (a, b) in enumerate(rng.integers(-50, 50, (300, 2)) / 4.0)]
    rows = [(i, [float(c) for c in v]) for i, v in rows]
    out = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in out} == {1, 2}
    assert max(r.identity_error for r in out) < 1e-9


def test_one_small_component(spark):
    """Variances that differ by 10^12."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b) / 64]) for i, (a, b) in enumerate(rng.integers(-40_000, 40_000, (400, 2)) // (1, 20_000))]
    check(whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), [i for i, _ in rows], [v for _, v in rows])


def test_beyond_64_bits(spark):
    rows = [(i, [float(2**30 * i), float(i % 3)]) for i in range(10)]
    out = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 20 and all(r.deviation is None for r in out if r.vec_id in (0, 9))
    assert max(r.identity_error for r in out) < 1e-4


def test_solve_and_shift():
    rng = np.random.default_rng(6)
    r = np.triu(rng.standard_normal((5, 5))) + 3 * np.eye(5)
    a = rng.standard_normal((7, 5))
    assert np.allclose(whiten.solve(a, r) @ r, a)
    g = np.ones((3, 3))
    f = whiten.shifted_factor(g, 10, False)
    assert np.allclose(f.T @ f, g, atol=1e-9) and np.allclose(f, np.triu(f))
