"""Whitening: exact sums, eigenpairs against a dense solver, the table's definitions, edge rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresscast.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def frame(spark, rows):
    df = spark.createDataFrame([(i, v) for i, v in rows], SCHEMA)
    for name in ("y", "n", "x", "component", "label", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def fit_of(rows):
    """Integer vectors of the usable rows and the distinct ones, by definition."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2**40 for c in v)]
    x = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in usable]
    return x, sorted({v for _, v in x})


def reference(fit):
    """Covariance in fractions, eigenpairs of a dense solver."""
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dims)]
    cov = np.array([[float(Fraction(sum((n * v[i] - sums[i]) * (n * v[j] - sums[j]) for v in fit), n**3))
                     for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    return n, sums, cov, values[::-1], axes[:, ::-1]


def check(rows, got, components=16):
    x, fit = fit_of(rows)
    n, sums, cov, values, axes = reference(fit)
    k = min(components, int((values > 1e-13 * cov.trace()).sum()))
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert len(got) == k * len(x)
    for i, v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        row = by_row[i, deviation]
        assert sorted(row) == list(range(1, k + 1))
        w = (np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)]) @ axes[:, :k]) / np.sqrt(values[:k])
        for c in range(k):
            for r in row[c + 1]:
                assert r["n"] == n and r["identity_error"] < 1e-9
                assert abs(r["explained"] - values[c] / cov.trace()) < 1e-12
            assert any(abs(abs(r["whitened"]) - abs(w[c])) < 1e-8 * (1 + abs(w[c])) for r in row[c + 1])
    for c in range(k):  # one sign for all rows
        signs = set()
        for i, v in x:
            w = np.array([float(Fraction(n * a - s, n)) for a, s in zip(v, sums)]) @ axes[:, c] / math.sqrt(values[c])
            same = [r["whitened"] for r in by_row[i, sum((n * a - s) ** 2 for a, s in zip(v, sums))][c + 1]]
            if len(set(same)) == 1 and abs(w) > 1e-6:
                signs.add(np.sign(w * same[0]))
        assert len(signs) <= 1


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    mix = rng.standard_normal((dims, dims)) * np.linspace(0.1, 3, dims)
    return [(i, (rng.standard_normal(dims) @ mix + 5).tolist()) for i in range(n)]


def run(spark, rows, **more):
    return [r.asDict() for r in whitening.whiten(frame(spark, rows), **more).collect()]


def test_against_fractions_and_a_dense_solver(spark):
    rows = vectors(90, 20, 1)
    rows += [(None, rows[3][1]), (3, rows[3][1]), (900, rows[7][1]), (901, [c + 1e-9 for c in rows[7][1]])]
    rows += [(902, None), (903, []), (904, [*rows[0][1][:-1], None]), (905, [*rows[0][1][:-1], math.nan]),
             (906, [*rows[0][1][:-1], math.inf]), (907, [-math.inf] * 20), (908, [1.0, 2.0]), (909, [1e200] * 20)]
    check([r for r in rows if r[0] != 908], run(spark, rows))


def test_low_rank_constant_and_small_tables(spark):
    rng = random.Random(2)
    line = [(i, [t, 2 * t, 0.0, 7.0, -t]) for i, t in enumerate(rng.uniform(-9, 9) for _ in range(40))]
    whole = [(i, [float(round(a)) for a in v]) for i, v in line]
    got = run(spark, whole)
    assert {r["component"] for r in got} == {1, 2, 3} or len({r["component"] for r in got}) <= 3
    check(whole, got)
    one = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    assert run(spark, one) == [] and run(spark, []) == [] and run(spark, [(1, None)]) == []
    check([(1, [0.0, 3.0]), (2, [1.0, 0.0])], run(spark, [(1, [0.0, 3.0]), (2, [1.0, 0.0])]))
    assert len(run(spark, line, components=1)) == 40


def test_large_entries_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-3e5, 3e5) for _ in range(4)]) for i in range(30)]
    check(rows, run(spark, rows))
    huge = [(i, [rng.uniform(-1e9, 1e9) for _ in range(4)]) for i in range(300)]
    assert any(r["deviation"] is None for r in run(spark, huge))


def test_products_of_any_size():
    rng = np.random.default_rng(4)
    for top in (1, 1 << 8, 1 << 20, 1 << 33, 1 << 40):
        y = rng.integers(-top, top, (50, 3), endpoint=True)
        want = y.astype(object).T @ y.astype(object)
        assert (whitening.exact_products(y) == want).all()


@pytest.mark.parametrize("dims", [1, 2, 3, 10, 64, 150])
def test_eigenpairs(dims):
    rng = np.random.default_rng(dims)
    for shape in ("random", "close", "equal", "decay"):
        values = {"random": rng.uniform(0.5, 9, dims), "close": 5 + 1e-5 * rng.uniform(0, 1, dims),
                  "equal": np.where(np.arange(dims) % 3 == 0, 4.0, 2.0), "decay": 0.5 ** np.arange(dims)}[shape]
        q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        found, axes = whitening.feast(v, 16)
        want = np.sort(values)[::-1][:16]
        want = want[want > 1e-13 * values.sum()]
        assert np.allclose(found, want, rtol=0, atol=1e-12 * values.max())
        assert np.abs(axes.T @ axes - np.eye(len(found))).max() < 1e-13
        assert np.abs(v @ axes - axes * found).max() < 1e-12 * values.max()


def test_inertia_counts():
    rng = np.random.default_rng(5)
    v = rng.standard_normal((30, 30))
    v = v @ v.T
    values = np.linalg.eigvalsh(v)
    form = whitening.tridiagonal(v)
    for point in rng.uniform(values[0] - 1, values[-1] + 1, 100):
        assert whitening.inertia_above(form, point)[0] == (values > point).sum()
