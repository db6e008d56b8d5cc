import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadsift.llm import whitening


def brute(vectors):
    """x vectors of the remaining rows by numpy, the fit list, and the eigenvalues and vectors of its covariance."""
    kept = [(i, v) for i, v in vectors if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    lengths = [len(v) for _, v in kept]
    dims = max(set(lengths), key=lambda n: (lengths.count(n), n))
    rows = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in kept if len(v) == dims]
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    centred = fit - fit.sum(0) / len(fit)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    return rows, fit, values[::-1], axes[:, ::-1]


def table(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    return df.withColumns({"whitening": F.lit("extra"), "_x": F.lit(1), "x": F.lit(2)})


def check(spark, vectors, components=4, tolerance=1e-9):
    df = table(spark, vectors)
    model = whitening.fit(df, "embedding", components)
    out, name = whitening.transform(df, "embedding", model)
    assert out.columns == [*df.columns, name]
    rows, fit, values, axes = brute([(i, None if v is None else [None if e is None else float(np.float32(e)) for e in v]) for i, v in vectors])
    n, sums = len(fit), fit.sum(0)
    assert model.n == n and model.sums == sums.tolist()
    found = out.collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0) for r in found) == sorted((i is None, i or 0) for i, _ in rows)
    of = {}
    for r in found:
        of.setdefault(r["vec_id"], []).append(r[name])
    sign = {}
    for i, x in rows:
        for got in of[i]:
            assert got["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)) or len(of[i]) > 1
    k = len(model.values)
    assert np.allclose(model.values, values[:k], rtol=1e-10, atol=0)
    for i, x in rows:
        if len(of[i]) == 1:
            want = (x - sums / n) @ axes[:, :k] / np.sqrt(values[:k])
            for c, (a, b) in enumerate(zip(of[i][0]["whitened"], want)):
                sign.setdefault(c, 1 if a * b >= 0 or abs(b) < 1e-6 else -1)
                assert abs(a * sign[c] - b) < tolerance
    if k:
        assert model.identity_error < 1e-10
        assert np.allclose(model.explained, values[:k] / values.sum(), rtol=1e-10)
    return model


def test_matches_a_symmetric_solver(spark):
    r = np.random.default_rng(1)
    mix = r.normal(size=(16, 16))
    vectors = [(i, (r.normal(size=16) @ mix + 40).tolist()) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(200)]  # a hot vector counts once
    assert len(check(spark, vectors).values) == 4


def test_invalid_rows_go_and_lengths_agree(spark):
    r = np.random.default_rng(2)
    good = [(i, r.normal(size=6).tolist()) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] + [0.0] * 5),
           (104, []), (105, [1.0, 2.0]), (None, good[0][1])]
    check(spark, good + bad)


def test_components_without_variance_do_not_exist(spark):
    r = np.random.default_rng(3)
    flat = [(i, [float(a), 2.0 * a, 7.0]) for i, a in enumerate(r.normal(size=50).round(2))]
    model = whitening.fit(table(spark, [(i, [v[0], v[0], 7.0]) for i, v in flat]), "embedding", 4)
    assert len(model.values) == 1
    one = whitening.fit(table(spark, [(1, [1.0, 2.0])] * 3), "embedding", 4)
    assert one.n == 1 and len(one.values) == 0
    out, name = whitening.transform(table(spark, [(1, [1.0, 2.0])] * 3), "embedding", one)
    assert [tuple(r[name]) for r in out.collect()] == [(0, [])] * 3


def test_empty_table(spark):
    df = table(spark, [])
    model = whitening.fit(df, "embedding", 4)
    assert model.n == 0 and whitening.transform(df, "embedding", model)[0].count() == 0


def test_small_eigenvalues_keep_their_digits():
    r = np.random.default_rng(4)
    q, _ = np.linalg.qr(r.normal(size=(30, 30)))
    values = np.logspace(0, -10, 30)
    factor = whitening.pivoted_cholesky(q @ np.diag(values) @ q.T)
    found, axes = whitening.one_sided_jacobi(factor)
    assert np.allclose(found[:20], values[:20], rtol=1e-8)
    assert np.allclose(axes.T @ axes, np.eye(axes.shape[1]), atol=1e-12)


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e16])
def test_deviations_are_exact(scale):
    x = (np.arange(12).reshape(4, 3) * scale).astype(np.int64)
    model = whitening.Whitening(4, 3, [int(v) for v in x.sum(0)], np.empty((3, 0)), np.empty(0), 0.0, None)
    want = [sum((4 * int(a) - s) ** 2 for a, s in zip(row, model.sums)) for row in x]
    assert whitening.deviations(x, model) == [w if w < 2 ** 63 else None for w in want]
