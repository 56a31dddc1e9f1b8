"""Layout invariance: results do not depend on the partitioning (1, 3 and 8 partitions,
empty partitions included)."""

import numpy as np
import pandas as pd
import pytest

from linfold import Preprocessor, evaluate_model, exact_quantiles, split_flag


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(31)
    n = 60
    pdf = pd.DataFrame({"k": np.arange(n), "a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float),
                        "c": rng.choice(["x", "y", "z"], n), "y": rng.normal(size=n)})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "c"] = None
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("parts", [1, 3, 8, 100])
def test_preprocessor_is_layout_invariant(frame, parts):
    base = Preprocessor(["a", "b", "c"]).fit(frame.repartition(1))
    other = Preprocessor(["a", "b", "c"]).fit(frame.repartition(parts))
    assert base.medians == other.medians and base.modes == other.modes
    assert base.categories == other.categories
    for c in ("a", "b"):
        assert other.means[c] == pytest.approx(base.means[c], rel=1e-12)
        assert other.scales[c] == pytest.approx(base.scales[c], rel=1e-12)


@pytest.mark.parametrize("parts", [1, 3, 8, 100])
def test_metrics_quantiles_split_are_layout_invariant(frame, parts):
    df = frame.repartition(parts).withColumnRenamed("a", "prediction").fillna(0.0, ["prediction"])
    ref = frame.repartition(1).withColumnRenamed("a", "prediction").fillna(0.0, ["prediction"])
    m1, m2 = evaluate_model(ref, "y"), evaluate_model(df, "y")
    for k in m1:
        assert m2[k] == pytest.approx(m1[k], rel=1e-12)
    assert exact_quantiles(frame.repartition(parts), ["a", "b"], 0.5) == \
        exact_quantiles(frame.repartition(1), ["a", "b"], 0.5)
    s1 = {r.k for r in split_flag(frame.repartition(parts), 0.25, 3, key="k", mode="exact")
          .filter("split = 'test'").collect()}
    s2 = {r.k for r in split_flag(frame.repartition(1), 0.25, 3, key="k", mode="exact")
          .filter("split = 'test'").collect()}
    assert s1 == s2 and len(s1) == 15


def test_approx_median_option(frame):
    exact = Preprocessor(["a", "b"]).fit(frame).medians
    approx = Preprocessor(["a", "b"], median="approx").fit(frame).medians
    assert approx["b"] in (0.0, 1.0, 2.0, 3.0)
    assert abs(approx["a"] - exact["a"]) < 0.5
