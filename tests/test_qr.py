"""Least squares by a tree of QR factors: near-collinear, scaled, singular and spread designs."""

import numpy as np
import pandas as pd
import pytest

from linfold import fit_ols, fit_ridge
from linfold.operators.qr import r_factor


def _frame(spark, x, y, parts=5):
    names = [f"x{j}" for j in range(x.shape[1])]
    return spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y)).repartition(parts), names


@pytest.mark.parametrize("eps", [1e-4, 1e-5, 1e-6, 1e-7, 1e-8])
def test_features_that_nearly_agree_keep_their_weights(spark, eps):
    rng = np.random.default_rng(5)
    a = rng.normal(size=400)
    x = np.column_stack([a, a + eps * rng.normal(size=400), rng.normal(size=400)])
    y = 1 + 2 * x[:, 0] + 3 * (x[:, 1] - x[:, 0]) / eps - x[:, 2]
    df, names = _frame(spark, x, y)
    model = fit_ols(df, names, "y")
    z = np.column_stack([np.ones(400), x])
    got = z @ model.weights
    assert np.sqrt(np.mean((got - y) ** 2)) < 1e-6
    want = z @ np.linalg.lstsq(z, y, rcond=None)[0]
    assert np.sqrt(np.mean((got - want) ** 2)) < 1e-6


def test_factor_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(300, 4)) * [1, 1e6, 1e-6, 3] + [0, 1e8, 5, -2], rng.normal(size=300)
    z = np.column_stack([np.ones(300), x, y])
    deviation = (x - x.mean(0)) / x.std(0)
    want = np.linalg.lstsq(deviation, y - y.mean(), rcond=None)[0] / x.std(0)
    for parts in (1, 3, 40):
        df, names = _frame(spark, x, y, parts)
        factor = r_factor(df, names, "y")
        assert factor.n == 300 and factor.r.shape == (6, 6)
        size = np.linalg.norm(z, axis=0)
        np.testing.assert_allclose((factor.r / size).T @ (factor.r / size), (z / size).T @ (z / size), atol=1e-12)
        np.testing.assert_allclose(fit_ols(df, names, "y", factor).coef, want, rtol=1e-6)


def test_fewer_rows_than_features_and_constant_features(spark):
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(3, 6)), rng.normal(size=3)
    x[:, 2] = 4.0
    df, names = _frame(spark, x, y, 2)
    model = fit_ols(df, names, "y")
    want = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    np.testing.assert_allclose(model.coef, want, atol=1e-9)
    np.testing.assert_allclose(model.intercept + x @ model.coef, y, atol=1e-9)


def test_ridge_of_near_collinear_features(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=200)
    x = np.column_stack([a, a + 1e-9 * rng.normal(size=200)])
    y = a + rng.normal(scale=0.1, size=200)
    df, names = _frame(spark, x, y)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.lstsq(np.vstack([xc, np.sqrt(0.5) * np.eye(2)]), np.append(yc, [0, 0]), rcond=None)[0]
    np.testing.assert_allclose(fit_ridge(df, names, "y", 0.5).coef, want, rtol=1e-9)
    with pytest.raises(ValueError, match="alpha"):
        fit_ridge(df, names, "y", -1.0)


def test_invalid_rows_and_empty_tables(spark):
    rows = [(1.0, 2.0), (None, 1.0), (float("nan"), 3.0), (2.0, float("inf"))]
    df = spark.createDataFrame(rows, "a double, y double")
    with pytest.raises(ValueError, match="1 rows hold NULL and 2 rows"):
        r_factor(df, ["a"], "y")
    with pytest.raises(ValueError, match="At least one row"):
        r_factor(df.limit(0), ["a"], "y")
    only = fit_ols(df.limit(1), [], "y")
    assert (only.intercept, len(only.coef)) == (2.0, 0)
