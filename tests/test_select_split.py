"""Exact order statistics and the splits, including forced refinement and hot values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linfold import chunk_of, exact_quantiles, kth_smallest, split_flag, train_test_split


def test_median_and_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    v = rng.lognormal(size=2001)
    w = np.concatenate([rng.normal(size=1000), [np.nan] * 5, rng.normal(size=995)])
    df = spark.createDataFrame(pd.DataFrame({"v": v[:2000], "w": w}))
    got = exact_quantiles(df, ["v", "w"], 0.5)
    assert got["v"] == np.median(v[:2000])
    assert got["w"] == np.nanmedian(w)
    assert exact_quantiles(df, ["v"], 0.9)["v"] == pytest.approx(np.quantile(v[:2000], 0.9), rel=1e-15)
    assert kth_smallest(df, "v", 17) == np.sort(v[:2000])[17]


def test_hot_value_holding_a_third_of_rows(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([np.full(700, 3.25), rng.normal(size=1400)])
    df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(5)
    assert exact_quantiles(df, ["v"], 0.5)["v"] == np.median(v)
    assert exact_quantiles(df, ["v"], 0.4)["v"] == pytest.approx(np.quantile(v, 0.4))


def test_grouped_median_with_null_key(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], size=900), "v": rng.normal(size=900)})
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r["v"] for r in exact_quantiles(df, ["v"], 0.5, by=["g"]).collect()}
    for key, grp in pdf.groupby(pdf["g"].fillna("<null>")):
        k = None if key == "<null>" else key
        assert got[k] == np.median(grp["v"])


def test_empty_and_all_null_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(df, ["v"])["v"] is None


def test_exact_split_size_and_determinism(spark):
    df = spark.range(1003).withColumn("k", F.col("id") * 7)
    flagged = split_flag(df, 0.2, 42, key="k", mode="exact")
    assert flagged.filter("split = 'test'").count() == 201      # ceil(0.2 * 1003)
    again = split_flag(df.repartition(5), 0.2, 42, key="k", mode="exact")
    a = {r.k for r in flagged.filter("split = 'test'").collect()}
    b = {r.k for r in again.filter("split = 'test'").collect()}
    assert a == b


def test_exact_split_with_duplicate_keys(spark):
    # a third of the rows share one key: ties broken by row id, size still exact
    df = spark.range(900).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    train, test = train_test_split(df, 0.5, 7, key="k", mode="exact")
    assert test.count() == 450 and train.count() == 450
    assert test.join(train, "id").count() == 0


def test_hash_split_is_layout_independent(spark):
    df = spark.range(500)
    a = {r.id for r in train_test_split(df, 0.3, 1, key="id")[1].collect()}
    b = {r.id for r in train_test_split(df.repartition(7), 0.3, 1, key="id")[1].collect()}
    assert a == b and 100 < len(a) < 200


def test_split_errors(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        split_flag(df, 0.999, mode="exact")   # ceil(2.997) = 3 test rows, train empty
    with pytest.raises(ValueError):
        split_flag(df, 1.5)
    with pytest.raises(ValueError):
        split_flag(df, 0.2, key="missing")


def test_grouped_median_mixes_windowed_and_refined_groups(spark):
    rng = np.random.default_rng(3)
    hot = pd.DataFrame({"g": "hot", "v": rng.normal(size=600), "w": 1.0})
    small = pd.DataFrame({"g": rng.choice([f"s{i}" for i in range(30)], 300),
                          "v": rng.integers(0, 5, 300).astype(float), "w": np.nan})
    pdf = pd.concat([hot, small], ignore_index=True)
    df = spark.createDataFrame(pdf)
    got = {r.g: (r.v, r.w) for r in exact_quantiles(df, ["v", "w"], 0.5, by=["g"]).collect()}
    assert len(got) == pdf["g"].nunique()
    for key, grp in pdf.groupby("g"):
        assert got[key][0] == np.median(grp["v"])
        assert got[key][1] == (1.0 if key == "hot" else None)


def test_grouped_median_default_limits_null_key(spark):
    pdf = pd.DataFrame({"g": ["a", "a", None, None, None, "b"], "v": [1.0, 2.0, 5.0, 1.0, 3.0, 7.0]})
    got = {r.g: r.v for r in exact_quantiles(spark.createDataFrame(pdf), ["v"], 0.5, by=["g"]).collect()}
    assert got == {"a": 1.5, None: 3.0, "b": 7.0}


def test_xxhash_split_is_layout_independent_and_sized(spark):
    df = spark.range(4000)
    a = {r.id for r in train_test_split(df, 0.25, 5, key="id", algorithm="xxhash64")[1].collect()}
    b = {r.id for r in train_test_split(df.repartition(6), 0.25, 5, key="id",
                                        algorithm="xxhash64")[1].collect()}
    assert a == b and 850 < len(a) < 1150
    exact = split_flag(df, 0.25, 5, key="id", mode="exact", algorithm="xxhash64")
    assert exact.filter("split = 'test'").count() == 1000


@pytest.mark.parametrize("seed", range(6))
def test_quantiles_match_numpy_on_random_shapes(spark, seed):
    """Random sizes, duplicate ratios, heavy tails, a hot value and q in [0, 1]; global and
    grouped."""
    rng = np.random.default_rng(100 + seed)
    n = int(rng.integers(50, 900))
    kind = seed % 3
    if kind == 0:
        v = rng.standard_cauchy(n)
    elif kind == 1:
        v = rng.integers(0, int(rng.integers(2, 60)), n).astype(float)
    else:
        v = np.where(rng.random(n) < 0.34, 7.5, rng.normal(size=n))
    g = rng.choice(["a", "b", "c"], n)
    q = float(rng.choice([0.0, 0.1, 0.5, 0.77, 1.0]))
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v})).repartition(int(rng.integers(1, 9)))
    assert exact_quantiles(df, ["v"], q)["v"] == pytest.approx(np.quantile(v, q), rel=1e-12, abs=1e-12)
    got = {r.g: r.v for r in exact_quantiles(df, ["v"], q, by=["g"]).collect()}
    for key in ("a", "b", "c"):
        sel = v[g == key]
        if len(sel):
            assert got[key] == pytest.approx(np.quantile(sel, q), rel=1e-12, abs=1e-12)
    k = int(rng.integers(0, n))
    assert kth_smallest(df, "v", k) == np.sort(v)[k]


@pytest.mark.parametrize("seed", range(4))
def test_exact_split_size_on_random_duplicates(spark, seed):
    rng = np.random.default_rng(500 + seed)
    n = int(rng.integers(20, 600))
    keys = rng.integers(0, int(rng.integers(1, 40)), n)
    keys[rng.random(n) < 0.33] = 3                      # a key holding a third of the rows
    frac = float(rng.choice([0.1, 0.2, 0.5]))
    df = spark.createDataFrame(pd.DataFrame({"row": np.arange(n), "k": keys})) \
        .repartition(int(rng.integers(1, 6)))
    train, test = train_test_split(df, frac, seed, key="k", mode="exact")
    t = {r.row for r in test.collect()}
    tr = {r.row for r in train.collect()}
    assert len(t) == int(np.ceil(frac * n)) and len(tr) == n - len(t) and not (t & tr)


def test_many_groups(spark):
    rng = np.random.default_rng(77)
    pdf = pd.DataFrame({"g": np.repeat(np.arange(200), 5), "v": rng.normal(size=1000)})
    got = {r.g: r.v for r in exact_quantiles(spark.createDataFrame(pdf), ["v"], 0.5, by=["g"]).collect()}
    for key, grp in pdf.groupby("g"):
        assert got[key] == np.median(grp["v"])


def test_split_errors_of_identical_rows(spark):
    from linfold import prepare_train_test_data
    same = spark.range(50).select(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    with pytest.raises(ValueError, match="split is empty"):
        prepare_train_test_data(same, "y", split_mode="hash")
    prepared = prepare_train_test_data(same, "y")
    assert (prepared.train.count(), prepared.test.count()) == (40, 10)


@pytest.mark.parametrize("algorithm", ["md5", "xxhash64"])
def test_nulls_have_a_place_in_the_key(spark, algorithm):
    from linfold.functions.exprs import hash52
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "x string, y string")
    assert df.select(hash52(1, "x", "y", algorithm=algorithm)).distinct().count() == 3


def test_chunks_are_a_grouping_key(spark):
    df = spark.range(600).withColumn("chunk", chunk_of("id", 4))
    again = spark.range(600).repartition(7).withColumn("chunk", chunk_of("id", 4))
    counts = {r["chunk"]: r["count"] for r in df.groupBy("chunk").count().collect()}
    assert set(counts) == {0, 1, 2, 3} and min(counts.values()) > 100
    assert df.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        chunk_of("id", 0)
