"""Chunk gradients and their sum, layout invariance, rejected rows, Gram statistics."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from linfold import (chunk_gradients, combine_chunks, compare_models, compute_gradient, compute_loss, fit_gd, fit_sgd,
                     gradient_frame, gradient_partials, gram_stats)


def _frame(spark, X, y, partitions):
    pdf = pd.DataFrame(X, columns=[f"x{i}" for i in range(X.shape[1])]).assign(y=y)
    return spark.createDataFrame(pdf).repartition(partitions), [f"x{i}" for i in range(X.shape[1])]


def _np_grad(X, y, w, alpha=0.0):
    Z = np.hstack([np.ones((len(y), 1)), X])
    g = 2.0 * Z.T @ (Z @ w - y) / len(y)
    g[1:] += 2.0 * alpha * w[1:]
    return g


def _sample(seed, n, d):
    rng = np.random.default_rng(seed)
    X = rng.uniform(-2, 3, size=(n, d))
    return X, X.sum(axis=1) - 1.0 + rng.normal(scale=0.2, size=n), rng.uniform(-1, 1, size=d + 1)


def test_chunks_of_any_size_add_up_to_the_whole_gradient(spark):
    X, y, w = _sample(101, 46, 2)
    df, feats = _frame(spark, X, y, 5)
    sizes = np.repeat([0, 1, 2, 3, 4], [1, 30, 2, 9, 4])      # uneven chunks, by a column
    df = spark.createDataFrame(df.toPandas().assign(c=sizes))
    chunks = chunk_gradients(df, feats, "y", w, F.col("c"))
    assert {r.chunk: r.n for r in chunks.collect()} == {0: 1, 1: 30, 2: 2, 3: 9, 4: 4}
    got = [r.gradient for r in combine_chunks(chunks, feats, w, 0.2).orderBy("idx").collect()]
    np.testing.assert_allclose(got, _np_grad(X, y, w, 0.2), rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(compute_gradient(df, feats, "y", w), _np_grad(X, y, w), rtol=1e-12, atol=1e-12)


def test_gradient_does_not_depend_on_the_layout(spark):
    X, y, w = _sample(202, 29, 5)
    df, feats = _frame(spark, X, y, 1)
    for parts in (1, 5, 50):   # 50 partitions leaves most of them empty
        np.testing.assert_allclose(compute_gradient(df.repartition(parts), feats, "y", w), _np_grad(X, y, w),
                                   rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("d", [2, 7, 13])
def test_rows_that_cannot_be_used_are_one_error_at_every_width(spark, d):
    rng = np.random.default_rng(d)
    pdf = pd.DataFrame(rng.normal(size=(20, d)), columns=[f"x{i}" for i in range(d)]).assign(y=1.0)
    rows = [[None if isinstance(v, str) else v for v in r] for r in pdf.astype(object).values.tolist()]
    rows[3][0] = None
    rows[5][1], rows[6][d] = float("inf"), float("nan")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns))
    feats = list(pdf.columns[:-1])
    message = "1 rows hold NULL and 2 rows hold NaN or infinite values"
    for call in (lambda: compute_gradient(df, feats, "y", np.zeros(d + 1)), lambda: gram_stats(df, feats, "y"),
                 lambda: compute_loss(df, feats, "y", np.zeros(d + 1)),
                 lambda: fit_gd(df, feats, "y", epochs=1, solver="per_epoch"),
                 lambda: fit_sgd(df, feats, "y", epochs=1)):
        with pytest.raises(ValueError, match=message):
            call()
    with pytest.raises(Exception, match=message):
        gradient_frame(df, feats, "y", np.zeros(d + 1)).collect()
    clean = df.where("x0 IS NOT NULL").where("x1 < 1e300").where("NOT isnan(y)")
    got = [r.gradient for r in gradient_frame(df, feats, "y", np.zeros(d + 1), invalid="skip").orderBy("idx").collect()]
    np.testing.assert_allclose(got, compute_gradient(clean, feats, "y", np.zeros(d + 1)), rtol=1e-12)


def test_names_with_dots_through_solvers_and_comparison(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x.y": rng.normal(size=60), "c_a": rng.normal(size=60)})
    pdf["t.g"] = 1 + 2 * pdf["x.y"] - pdf["c_a"]
    df = spark.createDataFrame(pdf)
    feats = ["x.y", "c_a"]
    for solver in ("gram", "per_epoch"):
        assert fit_gd(df, feats, "t.g", epochs=3, solver=solver).n_epochs == 3
    out, _ = compare_models(df, df, feats, "t.g", epochs=20)
    assert out.count() == 4


def test_chunk_partials_are_row_weighted_sums(spark):
    rng = np.random.default_rng(3)
    X, y, w = rng.normal(size=(9, 2)), rng.normal(size=9), rng.normal(size=3)
    df, feats = _frame(spark, X, y, 3)
    p = gradient_partials(df, feats, "y", w)
    Z = np.hstack([np.ones((9, 1)), X])
    e = Z @ w - y
    assert p.n == 9
    np.testing.assert_allclose(p.grad_sum, 2.0 * Z.T @ e, rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose(p.sse, e @ e, rtol=1e-12)


def test_arrow_path_equals_sql_path(spark):
    rng = np.random.default_rng(5)
    X, y, w = rng.normal(size=(50, 3)), rng.normal(size=50), rng.normal(size=4)
    df, feats = _frame(spark, X, y, 3)
    a = gradient_partials(df, feats, "y", w, method="sql")
    b = gradient_partials(df, feats, "y", w, method="arrow")
    np.testing.assert_allclose(a.grad_sum, b.grad_sum, rtol=1e-12, atol=1e-12)
    s1 = gram_stats(df, feats, "y", method="sql")
    for other in ("arrow", "covar"):
        s2 = gram_stats(df, feats, "y", method=other)
        np.testing.assert_allclose(s1.cxx, s2.cxx, rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(s1.cxy, s2.cxy, rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(s1.mean_x, s2.mean_x, rtol=1e-12, atol=1e-12)


def test_ridge_gradient_and_loss(spark):
    rng = np.random.default_rng(11)
    X, y, w = rng.normal(size=(30, 2)), rng.normal(size=30), rng.normal(size=3)
    df, feats = _frame(spark, X, y, 2)
    np.testing.assert_allclose(compute_gradient(df, feats, "y", w, alpha=0.3),
                               _np_grad(X, y, w, 0.3), rtol=1e-12, atol=1e-12)
    Z = np.hstack([np.ones((30, 1)), X])
    expected = np.mean((Z @ w - y) ** 2) + 0.3 * np.sum(w[1:] ** 2)
    assert compute_loss(df, feats, "y", w, alpha=0.3) == pytest.approx(expected, rel=1e-12)


def test_gram_statistics_survive_large_offsets(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(200, 2)) + 1e6
    y = 3.0 + X @ np.array([0.5, -0.25]) + 1e4
    df, feats = _frame(spark, X, y, 4)
    st = gram_stats(df, feats, "y")
    Xc = X - X.mean(axis=0)
    np.testing.assert_allclose(st.cxx, Xc.T @ Xc, rtol=1e-9)
    np.testing.assert_allclose(st.mean_x, X.mean(axis=0), rtol=1e-14)


def test_errors(spark):
    rng = np.random.default_rng(1)
    df, feats = _frame(spark, rng.normal(size=(5, 2)), rng.normal(size=5), 1)
    with pytest.raises(ValueError):
        compute_gradient(df, feats, "y", [0.0, 1.0])
    with pytest.raises(ValueError):
        compute_loss(df, feats, "y", [0.0, 1.0, 2.0], alpha=-1)
    with pytest.raises(ValueError):
        compute_gradient(df.limit(0), feats, "y", [0.0, 1.0, 2.0])


def test_wide_gram_spans_several_blocks(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(300, 130))
    y = X @ rng.normal(size=130) + 0.5
    df, feats = _frame(spark, X, y, 3)
    st = gram_stats(df, feats, "y")            # (131)^2 + ... numbers: more than one block
    Xc = X - X.mean(axis=0)
    np.testing.assert_allclose(st.cxx, Xc.T @ Xc, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(st.cxy, Xc.T @ (y - y.mean()), rtol=1e-9, atol=1e-9)
