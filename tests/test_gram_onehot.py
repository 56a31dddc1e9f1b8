"""One-hot-aware Gram statistics equal the dense Gram of the transformed columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold import fit_gd, gram_stats, prepare_train_test_data
from linfold.functions.exprs import line_count, word_count

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = docs.select("doc_id",
                     F.when(F.col("doc_id") % 7 == 0, None).otherwise(word_count("text")).alias("words"),
                     line_count("text").alias("lines"),
                     F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang")).alias("lang"),
                     "source", "n_chars")
    return prepare_train_test_data(df, "n_chars", 0.2, 42, 1000.0, id_columns=["doc_id"])


def test_onehot_gram_equals_dense(prepared):
    names = prepared.feature_names
    assert len(names) > 20                     # 2 numeric + lang + source categories
    dense = gram_stats(prepared.train, names, "n_chars")
    grouped = prepared.gram_stats()
    assert grouped.n == dense.n and grouped.features == dense.features
    np.testing.assert_allclose(grouped.mean_x, dense.mean_x, rtol=1e-10, atol=1e-12)
    np.testing.assert_allclose(grouped.cxx, dense.cxx, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(grouped.cxy, dense.cxy, rtol=1e-9, atol=1e-9)
    assert grouped.mean_y == pytest.approx(dense.mean_y, rel=1e-12)
    assert grouped.cyy == pytest.approx(dense.cyy, rel=1e-10)


def test_training_on_onehot_gram_matches(prepared):
    names = prepared.feature_names
    a = fit_gd(prepared.train, names, "n_chars", epochs=200, learning_rate=0.01, random_state=1)
    b = fit_gd(prepared.train, names, "n_chars", epochs=200, learning_rate=0.01, random_state=1,
               stats=prepared.gram_stats())
    np.testing.assert_allclose(a.weights, b.weights, rtol=1e-8, atol=1e-10)
    np.testing.assert_allclose(a.loss_history, b.loss_history, rtol=1e-8)


def test_onehot_partials_and_predictions_equal_dense(prepared):
    from linfold import gradient_partials, predict
    from linfold.operators.gram_onehot import onehot_partials
    names = prepared.feature_names
    w = np.random.default_rng(4).normal(size=len(names) + 1)
    dense = gradient_partials(prepared.train, names, "n_chars", w)
    grouped = onehot_partials(prepared.kept, prepared.preprocessor, "n_chars", w)
    assert grouped.n == dense.n
    np.testing.assert_allclose(grouped.grad_sum, dense.grad_sum, rtol=1e-9, atol=1e-9)
    assert grouped.sse == pytest.approx(dense.sse, rel=1e-10)
    a = predict(prepared.test, w, names).select("doc_id", "prediction").orderBy("doc_id").toPandas()
    b = prepared.raw_test.select("doc_id", prepared.prediction_column(w).alias("prediction")) \
        .orderBy("doc_id").toPandas()
    np.testing.assert_allclose(a["prediction"], b["prediction"], rtol=1e-12, atol=1e-12)


def test_prepared_fit_uses_grouped_passes(prepared):
    names = prepared.feature_names
    dense = fit_gd(prepared.train, names, "n_chars", epochs=100, learning_rate=0.01, random_state=2)
    grouped = prepared.fit_gd(epochs=100, learning_rate=0.01, random_state=2)
    np.testing.assert_allclose(grouped.weights, dense.weights, rtol=1e-8, atol=1e-10)
    per = prepared.fit_gd(epochs=5, learning_rate=0.01, random_state=2, solver="per_epoch")
    ref = fit_gd(prepared.train, names, "n_chars", epochs=5, learning_rate=0.01, random_state=2,
                 solver="per_epoch")
    np.testing.assert_allclose(per.weights, ref.weights, rtol=1e-9, atol=1e-10)


@pytest.mark.parametrize("seed", range(3))
def test_onehot_gram_random_two_categoricals(spark, seed):
    import pandas as pd
    from linfold import gradient_partials
    from linfold.operators.gram_onehot import onehot_partials
    rng = np.random.default_rng(900 + seed)
    n = int(rng.integers(80, 400))
    a = rng.choice(list("pqrst"), n).astype(object)
    a[rng.random(n) < 0.35] = "q"                          # hot category
    a[rng.random(n) < 0.1] = None
    b = rng.choice(["u v", "w", "x.y"], n).astype(object)
    b[rng.random(n) < 0.1] = None
    x = rng.normal(size=n) * 100 + 5
    x[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "x": x, "z": rng.integers(0, 9, n),
                        "y": rng.normal(size=n) * 1000 + 1e4})
    prep = prepare_train_test_data(spark.createDataFrame(pdf), "y", 0.25, seed, 1.0,
                                   id_columns=["id"])
    names = prep.feature_names
    dense = gram_stats(prep.train, names, "y")
    grouped = prep.gram_stats()
    np.testing.assert_allclose(grouped.cxx, dense.cxx, rtol=1e-9, atol=1e-8)
    np.testing.assert_allclose(grouped.cxy, dense.cxy, rtol=1e-9, atol=1e-6)
    np.testing.assert_allclose(grouped.mean_x, dense.mean_x, rtol=1e-10, atol=1e-12)
    w = rng.normal(size=len(names) + 1)
    p1 = gradient_partials(prep.train, names, "y", w)
    p2 = onehot_partials(prep.kept, prep.preprocessor, "y", w)
    np.testing.assert_allclose(p2.grad_sum, p1.grad_sum, rtol=1e-9, atol=1e-6)
