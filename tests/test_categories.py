"""Categories as a table: fit, transform, predict and normal equations, against the wide form."""

import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linfold.operators import categories as op
from linfold.operators.categories import CategoryModel, NormalEquations, numbered


def _frame(spark, n=300, seed=0, parts=4):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x": rng.normal(size=n) * 3 + 7, "z": rng.normal(size=n),
                        "c": rng.choice(["a", "b", "c, d", None], n), "d": rng.choice([f"k{i}" for i in range(40)], n),
                        "e": pd.Series([None] * n, dtype=object)})
    pdf.loc[: n // 3, "d"] = "hot"
    pdf.loc[::17, "x"] = np.nan
    pdf["y"] = 2 + pdf["z"] + pdf["c"].map({"a": 1.0, "b": -2.0}).fillna(0) + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame(pdf, "x double, z double, c string, d string, e string, y double")
    return df.repartition(parts), pdf


def _wide(pdf):
    x = pdf["x"].fillna(pdf["x"].median())
    num = np.column_stack([(v - v.mean()) / v.std(ddof=0) for v in (x, pdf["z"])])
    c = pdf["c"].fillna(pdf["c"].mode().min())
    names = [("c", v) for v in sorted(c.unique())] + [("d", v) for v in sorted(pdf["d"].unique())]
    hot = np.column_stack([(c if k == "c" else pdf["d"]) == v for k, v in names]).astype(float)
    return np.column_stack([num, hot]), names


def test_fit_keeps_categories_in_a_table(spark):
    df, pdf = _frame(spark)
    model = CategoryModel.fit(df, ["x", "z", "c", "d", "e"])
    c = pdf["c"].fillna(pdf["c"].mode().min())
    assert model.columns == ("c", "d") and model.modes["c"] == pdf["c"].mode().min()
    assert model.sizes == {"c": c.nunique(), "d": pdf["d"].nunique()}
    rows = sorted((r.id, model.columns[r.c], r.category, r.n) for r in model.table.collect())
    want = [("c", v, int((c == v).sum())) for v in sorted(c.unique())]
    want += [("d", v, int((pdf["d"] == v).sum())) for v in sorted(pdf["d"].unique())]
    assert rows == [(i, *w) for i, w in enumerate(want)]
    assert "hot" in model.hot["d"]


@pytest.mark.parametrize("limit", [op.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("alpha", [0.0, 2.5])
def test_weights_and_predictions_equal_the_wide_form(spark, monkeypatch, limit, alpha):
    """With the tables sent to every task, and by salted joins."""
    monkeypatch.setattr(op, "BROADCAST_BYTES", limit)
    df, pdf = _frame(spark)
    model = CategoryModel.fit(df, ["x", "z", "c", "d"])
    equations = NormalEquations(df, model, "y")
    weights = equations.solve(alpha)
    x, names = _wide(pdf)
    xc, y = x - x.mean(0), pdf["y"].to_numpy()
    v = np.random.default_rng(1).normal(size=x.shape[1])
    np.testing.assert_allclose(equations.times(v), xc.T @ (xc @ v), atol=1e-9)
    equations.release()
    if alpha:
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    else:
        want = np.linalg.lstsq(xc, y - y.mean(), rcond=None)[0]
    got = {(model.columns[r.c], r.category): r.weight for r in weights.table.collect()}
    np.testing.assert_allclose([*weights.numeric, *[got[k] for k in names]], want, atol=1e-9)
    np.testing.assert_allclose(weights.intercept, y.mean() - x.mean(0) @ want, atol=1e-9)
    scored = model.predict(df.withColumn("i", F.monotonically_increasing_id()), weights)
    assert scored.columns == [*df.columns, "i", "prediction"]
    out = scored.toPandas()
    order, own = out.sort_values(["y"]), pdf.assign(p=y.mean() + xc @ want).sort_values(["y"])
    np.testing.assert_allclose(order["prediction"], own["p"], atol=1e-8)


def test_unseen_categories_add_nothing_and_have_no_row(spark, monkeypatch):
    df, _ = _frame(spark)
    model = CategoryModel.fit(df, ["z", "c", "d"])
    equations = NormalEquations(df, model, "y")
    weights = equations.solve(1.0)
    equations.release()
    other = spark.createDataFrame([(1, 0.0, "never", "hot"), (2, 0.0, None, "new"), (3, None, "a", "hot")],
                                  "i int, z double, c string, d string")
    for limit in (op.BROADCAST_BYTES, 0):
        monkeypatch.setattr(op, "BROADCAST_BYTES", limit)
        long = sorted((r.i, r.column, r.category) for r in model.transform(other, ["i"]).collect())
        assert long == [(1, "d", "hot"), (2, "c", model.modes["c"]), (3, "c", "a"), (3, "d", "hot")]
        w = {(model.columns[r.c], r.category): r.weight for r in weights.table.collect()}
        at = {r.i: r.prediction for r in model.predict(other, weights).collect()}
        zero = (0.0 - model.numeric.means["z"]) / model.numeric.scales["z"] * weights.numeric[0]
        mid = (model.numeric.medians["z"] - model.numeric.means["z"]) / model.numeric.scales["z"] * weights.numeric[0]
        assert at[1] == pytest.approx(weights.intercept + zero + w["d", "hot"])
        assert at[2] == pytest.approx(weights.intercept + zero + w["c", model.modes["c"]])
        assert at[3] == pytest.approx(weights.intercept + mid + w["c", "a"] + w["d", "hot"])


def test_as_many_categories_as_rows(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("double").alias("y"))
    model = CategoryModel.fit(df, ["k"])
    assert model.sizes == {"k": 20_000} and not model.hot["k"]
    equations = NormalEquations(df, model, "y")
    weights = equations.solve(1.0)
    equations.release()
    # One row a category: half of its distance from the mean remains.
    out = model.predict(df, weights).select((F.col("prediction") - (F.col("y") + F.lit(equations.mean_y)) / 2).alias("e"))
    assert out.agg(F.max(F.abs("e"))).first()[0] < 1e-9
    assert weights.iterations < 20


def test_edges(spark):
    df, _ = _frame(spark, 30)
    with pytest.raises(ValueError, match="At least one training row"):
        CategoryModel.fit(df.limit(0), ["c"])
    only = CategoryModel.fit(df, ["x", "z"])
    assert only.size == 0 and only.columns == ()
    with pytest.raises(ValueError, match="no categorical"):
        only.transform(df, ["y"])
    assert [r.id for r in numbered(df.select("d").distinct(), ["d"]).orderBy("d").collect()] == list(range(df.select("d").distinct().count()))


def test_the_driver_gets_no_number_per_category(spark, monkeypatch):
    df = spark.range(20_000).select((F.col("id") % 10_000).cast("string").alias("k"), (F.col("id") % 3).cast("string").alias("g"),
                                    (F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"))
    plain, got = type(df).collect, []

    def collect(self):
        rows = plain(self)
        got.append(len(pickle.dumps([tuple(r) for r in rows])))
        return rows

    model = CategoryModel.fit(df, ["x", "k", "g"])
    monkeypatch.setattr(type(df), "collect", collect)
    equations = NormalEquations(df, model, "y")
    weights = equations.solve(1.0)
    equations.release()
    assert sum(got) < 20_000   # bytes, over all products
    monkeypatch.undo()
    train = df.toPandas()
    k, g = train["k"].astype(int).to_numpy(), train["g"].astype(int).to_numpy()
    w = {(model.columns[r.c], r.category): r.weight for r in weights.table.collect()}
    x = (train["x"].to_numpy() - model.numeric.means["x"]) / model.numeric.scales["x"]
    own = np.array([w["k", str(i)] for i in range(10_000)])
    rest = train["y"].to_numpy() - weights.intercept - weights.numeric[0] * x - np.array([w["g", str(i)] for i in range(3)])[g]
    # Ridge: the residuals of a category's rows sum to its weight; all of them to zero.
    np.testing.assert_allclose(np.bincount(k, rest) - np.bincount(k) * own, own, atol=1e-8)
    assert abs((rest - own[k]).sum()) < 1e-6 and weights.table.count() == 10_003
