"""Error conditions the reference defines (one test each)."""

import pytest

from linfold import feature_types, fit_sgd, split_target
from linfold.functions.exprs import hash52
from linfold.plans.jobs import run_suite
from linfold.session import materialize


def test_no_feature_columns(spark):
    df = spark.createDataFrame([(1.0,)], "y double")
    frame, features = split_target(df, "y")
    with pytest.raises(ValueError, match="feature"):
        feature_types(frame.schema, features)


def test_repeats_must_be_positive(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    with pytest.raises(ValueError, match="repeats"):
        run_suite(spark, df, df, ["x"], "y", epochs=1, partitions=[1], repeats=0)


def test_sgd_arguments(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    with pytest.raises(ValueError):
        fit_sgd(df, ["x"], "y", epochs=1, batches=0)
    with pytest.raises(ValueError):
        fit_sgd(df, ["x"], "y", epochs=0)


def test_unknown_options(spark):
    with pytest.raises(ValueError):
        hash52(1, "x", algorithm="crc")
    with pytest.raises(ValueError):
        materialize(spark.range(1), "local")
