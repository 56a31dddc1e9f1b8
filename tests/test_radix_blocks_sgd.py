"""Radix selection, packed blocks, resumable training and row-wise SGD."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linfold import exact_quantiles, fit_gd, kth_smallest
from linfold.functions.exprs import hash52
from linfold.operators import radix
from linfold.operators.blocks import PackedTable, row_marks
from linfold.operators.select import kth_smallest_with_counts
from linfold.operators.sgd import batch_products, fit_sgd_rows, step_map


def test_images_keep_the_order():
    v = np.array([-np.inf, -1e308, -1.5, -5e-324, 0.0, 5e-324, 1e-300, 1.0, 1.5, np.inf])
    img = radix.image(v)
    assert (np.diff(img.astype(object)) > 0).all()
    assert [radix.value_of(int(i), False) for i in img] == v.tolist()
    assert radix.image(np.array([-0.0]))[0] == radix.image(np.array([0.0]))[0]
    w = np.array([-2**63, -1, 0, 1, 2**63 - 1], dtype=np.int64)
    assert (np.diff(radix.image(w).astype(object)) > 0).all()
    assert [radix.value_of(int(i), True) for i in radix.image(w)] == w.tolist()


def test_ranks_ties_and_odd_values(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), np.full(300, 2.5),
                        [0.0, -0.0, np.inf, -np.inf], [np.nan] * 20])
    df = spark.createDataFrame(pd.DataFrame({"v": v})).union(spark.createDataFrame([(None,)] * 7, "v double")).repartition(6)
    s = np.sort(v[~np.isnan(v)])
    ranks = [0, 1, 250, 400, len(s) - 1]
    found = radix.select_ranks(df, ["v"], lambda total: [*ranks, total, -1])[0]
    assert sorted(found) == ranks
    for r in ranks:
        assert (found[r].value, found[r].less, found[r].equal) == (s[r], (s < s[r]).sum(), (s == s[r]).sum())


def test_large_integers_are_not_rounded(spark):
    big = [2**62 + i for i in range(50)] + [-(2**63), 2**63 - 1] + [2**62 + 7] * 9
    df = spark.createDataFrame([(b,) for b in big], "k long").repartition(3)
    s = sorted(big)
    for k in (0, 8, 12, 60):
        assert kth_smallest_with_counts(df, "k", k) == (s[k], sum(x < s[k] for x in s), s.count(s[k]))
    assert kth_smallest(df, "k", 3) == s[3]
    with pytest.raises(ValueError, match="outside"):
        kth_smallest(df, "k", 61)
    with pytest.raises(TypeError):
        kth_smallest(df.select(F.col("k").cast("string")), "k", 0)


def test_no_value_is_shuffled(spark):
    """The exchanges of a pass carry blocks of counts."""
    df = spark.range(100).select((F.col("id") * 1.5).alias("v"))
    seen = []
    inner = radix.sum_blocks
    try:
        radix.sum_blocks = lambda parts, width: (seen.append(parts.columns), inner(parts, width))[1]
        assert exact_quantiles(df, ["v"])["v"] == 74.25
    finally:
        radix.sum_blocks = inner
    assert seen == [["blk", "vals"]] * 6


def test_packed_table(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(1000, 3)), columns=["a", "b", "y"])
    df = spark.createDataFrame(pdf)
    one, two = (PackedTable(df.repartition(n), ["a", "b"], "y") for n in (1, 7))
    assert one.n == two.n == 1000 and one.mark == two.mark == row_marks(pdf.to_numpy()) % 2**64
    np.testing.assert_allclose(two.sum(lambda block: block.sum(axis=0), 3), pdf.sum())
    other = PackedTable(df.withColumn("a", F.col("a") + F.when(F.col("b") > 2.5, 1e-9).otherwise(0.0)), ["a", "b"], "y")
    assert other.mark != one.mark
    bad = df.union(spark.createDataFrame([(None, 1.0, 2.0), (1.0, float("nan"), 0.0)], "a double, b double, y double"))
    with pytest.raises(ValueError, match="1 rows hold NULL and 1 rows"):
        PackedTable(bad, ["a", "b"], "y")
    assert PackedTable(bad, ["a", "b"], "y", invalid="skip").mark == one.mark
    with pytest.raises(ValueError, match="At least one row"):
        PackedTable(df.limit(0), ["a", "b"], "y")


def _linear(spark, n=400, parts=4):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 3))
    y = 1 + x @ [1.0, -2.0, 0.5] + rng.normal(scale=0.1, size=n)
    return spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, k=np.arange(n))).repartition(parts)


def test_training_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    df, names = _linear(spark), ["a", "b", "c"]
    kwargs = dict(learning_rate=0.05, alpha=0.01, random_state=3, solver="per_epoch")
    whole = fit_gd(df, names, "y", epochs=12, **kwargs)
    from linfold.operators import gd

    calls, inner = [], gd._packed_partial

    def broken(packed, w):
        calls.append(1)
        if len(calls) == 8:   # the start and six epochs are through
            raise RuntimeError("driver lost")
        return inner(packed, w)

    monkeypatch.setattr(gd, "_packed_partial", broken)
    with pytest.raises(RuntimeError):
        fit_gd(df, names, "y", epochs=12, state_dir=str(tmp_path), state_every=2, **kwargs)
    monkeypatch.setattr(gd, "_packed_partial", lambda p, w: (calls.append(2), inner(p, w))[1])
    again = fit_gd(df.repartition(3), names, "y", epochs=12, state_dir=str(tmp_path), state_every=2, **kwargs)
    assert calls.count(2) == 7   # epochs 7 to 12, and the gradient they start from
    np.testing.assert_allclose(again.loss_history, whole.loss_history, rtol=1e-12)
    np.testing.assert_allclose(again.weights, whole.weights, rtol=1e-12)
    # Done: no further pass; more epochs go on; other settings or data begin anew.
    calls.clear()
    assert fit_gd(df, names, "y", epochs=12, state_dir=str(tmp_path), **kwargs).loss_history == again.loss_history
    assert not calls
    more = fit_gd(df, names, "y", epochs=14, state_dir=str(tmp_path), **kwargs)
    assert len(calls) == 3 and more.loss_history[:12] == again.loss_history
    calls.clear()
    fit_gd(df, names, "y", epochs=2, state_dir=str(tmp_path), **{**kwargs, "alpha": 0.02})
    fit_gd(df.where("k > 0"), names, "y", epochs=2, state_dir=str(tmp_path), **kwargs)
    assert len(calls) == 6
    with pytest.raises(ValueError, match="random_state"):
        fit_gd(df, names, "y", epochs=2, solver="per_epoch", state_dir=str(tmp_path))


def test_early_stopping_state_is_kept(spark, tmp_path):
    df, names = _linear(spark), ["a", "b", "c"]
    kwargs = dict(learning_rate=0.2, random_state=3, solver="per_epoch", early_stopping=True, tol=1e-3, patience=3)
    whole = fit_gd(df, names, "y", epochs=60, **kwargs)
    assert whole.n_epochs < 60
    fit_gd(df, names, "y", epochs=whole.n_epochs - 1, state_dir=str(tmp_path), state_every=1, **kwargs)
    for _ in range(2):
        again = fit_gd(df, names, "y", epochs=60, state_dir=str(tmp_path), state_every=1, **kwargs)
        assert again.n_epochs == whole.n_epochs
        np.testing.assert_allclose(again.loss_history, whole.loss_history, rtol=1e-12)


def _loop(z, y, w, rate, alpha):
    decay = np.concatenate([[0.0], np.full(z.shape[1] - 1, alpha)])
    for row, target in zip(z, y):
        w = w - rate * ((row @ w - target) * row + decay * w)
    return w


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 100])
def test_step_map_equals_the_loop(n):
    rng = np.random.default_rng(n)
    z, y = np.column_stack([np.ones(n), rng.normal(size=(n, 4))]), rng.normal(size=n)
    a, b = step_map(z, y, 0.05, 0.3)
    for _ in range(3):
        w = rng.normal(size=5)
        np.testing.assert_allclose(a @ w + b, _loop(z, y, w, 0.05, 0.3), rtol=1e-11, atol=1e-12)


@pytest.mark.parametrize("alpha", [0.0, 0.2])
def test_row_wise_sgd_equals_the_loop_in_any_layout(spark, alpha):
    df, names = _linear(spark, 700), ["a", "b", "c"]
    df = df.union(df.where("k < 40"))   # repeated keys
    rows = df.withColumn("h", hash52(9, "k")).toPandas().sort_values(["h", *names, "y"])
    z = np.column_stack([np.ones(len(rows)), rows[names]])
    w = np.zeros(4)
    for _ in range(3):
        w = _loop(z, rows["y"].to_numpy(), w, 0.01, alpha)
    for parts in (1, 9):
        got = fit_sgd_rows(df.repartition(parts), names, "y", 3, 0.01, alpha, 9, ["k"])
        np.testing.assert_allclose(got.weights, w, rtol=1e-9)


def test_row_wise_sgd_rejects_invalid_rows_and_tells_divergence(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, y double")
    with pytest.raises(ValueError, match="1 rows hold NULL"):
        fit_sgd_rows(df, ["a"], "y", 1)
    with pytest.raises(ValueError, match="At least one row"):
        fit_sgd_rows(df.limit(0), ["a"], "y", 1)
    wild = spark.createDataFrame([(1e3 * i, float(i)) for i in range(40)], "a double, y double")
    assert fit_sgd_rows(wild, ["a"], "y", 50, 1.0).diverged


def test_mini_batch_products_add_up_in_place(spark):
    df = _linear(spark, 300, 3)
    total = batch_products(df, ["a", "b", "c"], "y", 7, 1).sum(axis=0)
    z = df.select(F.lit(1.0), "a", "b", "c", "y").toPandas().to_numpy()
    np.testing.assert_allclose(total, z.T @ z, rtol=1e-10)


@pytest.mark.parametrize("alpha", [0.0, 0.1])
@pytest.mark.parametrize("rank", [6, 4])
def test_spectral_epochs_equal_the_loop(alpha, rank):
    """Full and short rank, with and without a penalty, over several blocks of epochs."""
    from linfold.operators import gd
    from linfold.operators.gram import GradientPartial, GramStats, penalty_diagonal
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, 6)) + 3
    y = x @ rng.normal(size=6) + rng.normal(size=200)
    z = np.column_stack([np.ones(200), x])
    xc, yc = x - x.mean(0), y - y.mean()
    stats = GramStats(tuple("abcdef"), 200, x.mean(0), y.mean(), xc.T @ xc, xc.T @ yc, float(yc @ yc))
    star = rng.normal(size=7) * 0.1 + np.linalg.lstsq(z, y, rcond=None)[0]   # any point will do
    e = z @ star - y
    objective = gd._GramObjective(stats, star, GradientPartial(200, e.sum(), x.T @ e, float(e @ e)))
    diagonal, w0 = penalty_diagonal(7, alpha), rng.normal(size=7)
    w, trace = gd._spectral_descend(objective, w0, 1300, 0.002, diagonal, None)
    own, losses = w0, []
    for _ in range(1300):
        own = own - 0.002 * (2 * z.T @ (z @ own - y) / 200 + 2 * diagonal * own)
        losses.append(np.mean((z @ own - y) ** 2) + diagonal @ own ** 2)
    np.testing.assert_allclose(w, own, rtol=1e-8, atol=1e-9)
    np.testing.assert_allclose(trace, losses, rtol=1e-9)
    stop, plain = gd.Plateau(1e-4, 7), gd.Plateau(1e-4, 7)
    w, trace = gd._spectral_descend(objective, w0, 1300, 0.002, diagonal, stop)
    want = next((i + 1 for i, loss in enumerate(losses) if plain.full(loss)), 1300)
    assert len(trace) == want


def test_many_spectral_epochs_take_no_loop():
    import time

    from linfold.operators import gd
    from linfold.operators.gram import GradientPartial, GramStats, penalty_diagonal
    rng = np.random.default_rng(1)
    a = rng.normal(size=(900, 500))
    stats = GramStats(tuple(map(str, range(500))), 900, np.zeros(500), 0.0, a.T @ a, np.zeros(500), 1.0)
    objective = gd._GramObjective(stats, np.zeros(501), GradientPartial(900, 0.0, np.zeros(500), 0.0))
    began = time.perf_counter()
    _, trace = gd._spectral_descend(objective, np.ones(501), 100_000, 0.01, penalty_diagonal(501, 0.0), None)
    assert len(trace) == 100_000 and time.perf_counter() - began < 5


def test_counter_numbers_are_normal_and_do_not_depend_on_the_layout(spark):
    from linfold.sources.synth import counter_normals, synthetic_frame
    z = counter_normals(np.arange(-50_000, 50_000), 5, 42)
    assert np.abs(z.mean(0)).max() < 0.02 and np.abs(z.std(0) - 1).max() < 0.02
    assert np.abs(np.corrcoef(z.T) - np.eye(5)).max() < 0.02
    assert np.abs(np.corrcoef(z[1:, 0], z[:-1, 0])[0, 1]) < 0.02
    assert not np.array_equal(z, counter_normals(np.arange(-50_000, 50_000), 5, 43))
    rows = [sorted(map(tuple, synthetic_frame(spark, 200, 4, 0.1, 7, "counter", num_partitions=n)[0].collect()))
            for n in (1, 3, 8)]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 200


def test_half_a_pair_of_splits_is_refused(spark, tmp_path):
    from linfold import prepare_train_test_data
    from linfold.sources import io
    df = _linear(spark).drop("k")
    prep = prepare_train_test_data(df, "y", 0.25, 1, 1.0)
    io.save_processed_splits(prep, str(tmp_path / "a"))
    train, test = io.load_processed_splits(spark, str(tmp_path / "a"))
    assert (train.count(), test.count()) == (300, 100)

    class Broken:
        train, feature_names, target_column = prep.train, prep.feature_names, prep.target_column

        @property
        def test(self):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        io.save_processed_splits(Broken(), str(tmp_path / "b"))
    io.write_table(prep.train, str(tmp_path / "b" / "train_processed"), "parquet")
    with pytest.raises(ValueError, match="complete pair"):
        io.load_processed_splits(spark, str(tmp_path / "b"))
    io.write_table(prep.test.limit(3), str(tmp_path / "a" / "test_processed"), "parquet")
    with pytest.raises(ValueError, match="3 rows, not 100"):
        io.load_processed_splits(spark, str(tmp_path / "a"))
    prep.release()
