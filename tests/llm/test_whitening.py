import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from condoflow.llm.whitening import characteristic_polynomial, largest_roots, op12_embedding_whitening, roots_above, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component string"


def determinant(m):
    m, d, out = [[Fraction(v) for v in row] for row in m], len(m), Fraction(1)
    for k in range(d):
        pivot = next((i for i in range(k, d) if m[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            m[k], m[pivot], out = m[pivot], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, d):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


def brute(rows, k=4):
    """n, rows kept as integers, exact deviations, eigenvalues and projections by numpy."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in kept}), float)
    n, s = len(fit), [sum(int(v) for v in c) for c in fit.T]
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    order = np.argsort(-values)[:k]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s)) for _, v in kept]
    projected = (np.array([v for _, v in kept], float) - np.array(s) / n) @ vectors[:, order] / np.sqrt(values[order])
    return n, [i for i, _ in kept], deviation, projected, values[order] / values.sum()


def test_polynomial_is_exact(spark):
    a = np.random.default_rng(1).integers(-50, 50, (9, 7))
    m = (a.T @ a).tolist()
    poly = characteristic_polynomial(spark, m)
    for t in (0, 1, -3, 1000):
        assert sum(c * t**k for k, c in enumerate(poly)) == determinant([[(t if i == j else 0) - m[i][j] for j in range(7)] for i in range(7)])
    values = np.linalg.eigvalsh(np.array(m, float))[::-1]
    roots = [t / 2**b for t, b, _ in largest_roots(poly, 4)]
    assert np.allclose(roots, values[:4], rtol=1e-12)
    assert [roots_above(poly, math.ceil(v) + 1, 0) for v in values] == [sum(u > math.ceil(v) + 1 for u in values) for v in values]


def test_repeated_roots():
    # (t - 5)^3 (t - 2) t
    poly = [0, 250, -275, 105, -17, 1]
    assert [(t >> b if t % (1 << b) == 0 else t / 2**b, m) for t, b, m in largest_roots(poly, 4)] == [(5, 3), (2, 1)]


def test_given_table_against_brute_force(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    out = op12_embedding_whitening(given).collect()
    n, ids, deviation, projected, explained = brute([(r.vec_id, r.embedding) for r in given.collect()])
    by = {(r.vec_id, r.component): r for r in out}
    assert len(by) == len(out) == 4 * len(ids)
    for c in range(4):
        got = np.array([by[i, c + 1].whitened for i in ids])
        assert min(np.abs(got - projected[:, c]).max(), np.abs(got + projected[:, c]).max()) < 1e-8
        assert abs(by[ids[0], c + 1].explained / explained[c] - 1) < 1e-9
    assert [by[i, 1].deviation for i in ids] == deviation and all(r.n == n for r in out)
    assert out[0].identity_error < 1e-9 and len({r.identity_error for r in out}) == 1


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(40)]
    rows += [(40, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (41, None), (42, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (43, [float("nan")] + [0.0] * 5),
             (44, [float("-inf")] + [0.0] * 5), (45, [0.0] * 6), (46, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x", "n", "c") for i, v in rows], SCHEMA).repartition(5)
    out = op12_embedding_whitening(df).collect()
    n, ids, deviation, projected, _ = brute([(i, None if v is None else [None if c is None else np.float32(c) for c in v]) for i, v in rows])
    assert len(out) == 4 * len(ids) and out[0].n == n == 41 and out[0].identity_error < 1e-9
    assert sorted(r.deviation for r in out if r.component == 1) == sorted(deviation)
    first = sorted(abs(r.whitened) for r in out if r.component == 2)
    assert np.allclose(first, sorted(np.abs(projected[:, 1])))
    assert sum(r.vec_id is None for r in out) == 4 and sum(r.vec_id == 0 for r in out) == 8


def test_equal_eigenvalues_and_missing_spread(spark):
    cross = [(k, [s if j == a else 0.0 for j in range(5)]) for k, (a, s) in enumerate((a, s) for a in range(3) for s in (1.0, -1.0))]
    df = spark.createDataFrame(cross, "vec_id long, embedding array<double>")
    out = op12_embedding_whitening(df).collect()
    assert out[0].identity_error < 1e-9 and all(abs(r.explained - 1 / 3) < 1e-12 for r in out if r.component < 4)
    assert all((r.whitened is None) == (r.component == 4) and (r.component < 4 or r.explained == 0) for r in out)
    one = op12_embedding_whitening(df.where("vec_id = 0")).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(c, 1, 0, None, 0.0) for c in range(1, 5)]


def test_short_wide_and_huge_vectors(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [0.5, 2.0]), (3, [])], "vec_id long, embedding array<double>")
    out = whiten(df).collect()
    assert {(r.id, r.component) for r in out} == {(i, c) for i in (1, 2, 3) for c in (1, 2)}
    assert {r.id: r.deviation for r in out} == {1: (3 * 256 - 384) ** 2 + 512**2, 2: 0 + (3 * 512 - 512) ** 2, 3: 384**2 + 512**2}
    huge = spark.createDataFrame([(k, [c, 1.0]) for k, c in enumerate((1e12, -3e13, 5e12, 1e300))], "vec_id long, embedding array<double>")
    out = whiten(huge, 1).collect()
    x = [256 * 10**12, -256 * 3 * 10**13, 256 * 5 * 10**12, 2**63 - 1]
    assert {r.id: int(r.deviation_exact) for r in out} == {k: (4 * v - sum(x)) ** 2 for k, v in enumerate(x)}
    assert all(r.deviation is None for r in out) and abs(out[0].explained - 1) < 1e-12 and out[0].identity_error < 1e-6


@pytest.mark.parametrize("where", ["false", "vec_id = 1"])
def test_nothing_left(spark, where):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>").where(where)
    assert op12_embedding_whitening(df).collect() == []


def test_order_of_rows_does_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    a, b = (sorted(tuple(r)[:3] + (round(r.whitened, 9),) for r in op12_embedding_whitening(d).collect()) for d in (df, df.orderBy(F.rand(1)).repartition(7)))
    assert a == b
