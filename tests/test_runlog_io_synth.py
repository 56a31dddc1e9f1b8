"""Run statistics, sources/sinks and synthetic data."""

import json
import os

import numpy as np
import pandas as pd
import pytest

from linfold import (add_speedup, load_table, make_synthetic_regression, report_series,
                     run_stats, write_results)
from linfold.operators.runlog import loss_history_frame
from linfold.session import scratch_path
from linfold.sources.io import write_table
from linfold.sources.synth import synthetic_frame, true_weights

LOG = [("Custom GD", "serial", 1, 0, 2.0), ("Custom GD", "serial", 1, 1, 4.0),
       ("Custom GD", "serial", 1, 2, 3.0), ("Custom GD", "spark", 2, 0, 2.0),
       ("Custom GD", "spark", 4, 0, 1.0), ("Custom GD", "spark", 4, 1, 1.0),
       ("lib", "ols", None, 0, 0.5)]


def _log(spark):
    return spark.createDataFrame(LOG, "model string, implementation string, processes bigint, "
                                      "repeat int, seconds double")


def test_run_stats_and_speedup(spark):
    stats = add_speedup(run_stats(_log(spark)), {"implementation": "serial", "processes": 1})
    rows = {(r.implementation, r.processes): r for r in stats.collect()}
    serial = rows[("serial", 1)]
    assert serial.median_time == 3.0 and serial.min_time == 2.0 and serial.max_time == 4.0
    assert serial.std_time == pytest.approx(np.std([2.0, 4.0, 3.0]))
    assert (serial.speedup, serial.efficiency) == (1.0, 1.0)
    assert rows[("spark", 2)].std_time == 0.0                     # one repeat
    assert rows[("spark", 4)].speedup == 3.0 and rows[("spark", 4)].efficiency == 0.75
    assert rows[("ols", None)].speedup is None and rows[("ols", None)].efficiency is None


def test_efficiency_against_a_baseline_of_several_processes(spark):
    log = spark.createDataFrame([("m", "a", 100, 0, 8.0), ("m", "a", 200, 0, 4.0)],
                                "model string, implementation string, processes bigint, repeat int, seconds double")
    rows = {r.processes: r for r in add_speedup(run_stats(log), {"implementation": "a", "processes": 100}).collect()}
    assert (rows[200].speedup, rows[200].efficiency) == (2.0, 1.0)


def test_csv_as_pandas_writes_it(spark, tmp_path):
    pdf = pd.DataFrame({"i": [1, 2, 3], "s": ['say "hi", ok', " pad ", "two\nlines"], "x": [1.5, np.nan, 2.0]})
    path = tmp_path / "p.csv"
    pdf.to_csv(path, index=False)
    rows = load_table(spark, str(path), multi_line=True).orderBy("i").collect()
    assert [r.s for r in rows] == pdf["s"].tolist() and rows[1].x is None
    typed = load_table(spark, str(path), schema="i int, s string, x double", multi_line=True).orderBy("i").collect()
    assert [tuple(r) for r in typed] == [(1, 'say "hi", ok', 1.5), (2, " pad ", None), (3, "two\nlines", 2.0)]
    (tmp_path / "n.csv").write_text("a,b\n1,N/A\n2,3.5\n")
    assert [r.b for r in load_table(spark, str(tmp_path / "n.csv"), schema="a int, b double").orderBy("a").collect()] == [None, 3.5]
    out = write_table(spark.createDataFrame(pdf.fillna(0.0)), scratch_path(spark, "csv"), "csv")
    assert [r.s for r in load_table(spark, out, "csv", multi_line=True).orderBy("i").collect()] == pdf["s"].tolist()


def test_report_series_drops_nulls_and_labels(spark):
    stats = add_speedup(run_stats(_log(spark)), {"implementation": "serial", "processes": 1})
    series = report_series(stats, "speedup").collect()
    assert [r.label for r in series] == ["serial (1p)", "spark (2p)", "spark (4p)"]
    hist = loss_history_frame(spark, {"serial": [3.0, 2.0]}).collect()
    assert [(r.epoch, r.loss) for r in hist] == [(1, 3.0), (2, 2.0)]


def test_csv_typing_like_pandas(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,f,na,b,d,s\n1,1.5,NA,True,2020-01-01,x\n2,2.0,3,False,2020-01-02,NEAR BAY\n"
                    "3,,4.5,True,2020-01-03,y\n")
    df = load_table(spark, str(path))
    types = dict(df.dtypes)
    assert types == {"i": "bigint", "f": "double", "na": "double", "b": "boolean",
                     "d": "string", "s": "string"}
    rows = df.orderBy("i").collect()
    assert rows[0].na is None and rows[2].f is None and rows[1].b is False


def test_missing_path_is_a_clear_error(spark):
    with pytest.raises(FileNotFoundError, match="not found"):
        load_table(spark, "/no/such/file.csv")


def test_results_json_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", float("nan"), 1.0)], "m string, speedup double, x double")
    path = write_results(df, scratch_path(spark, "res"), "json")
    local = path[len("file:"):] if path.startswith("file:") else path
    lines = [line for f in os.listdir(local) if f.endswith(".json")
             for line in open(os.path.join(local, f)) if line.strip()]
    assert json.loads(lines[0]) == {"m": "a", "speedup": None, "x": 1.0}
    back = load_table(spark, path, "json")
    assert back.collect()[0]["speedup"] is None


def test_synthetic_is_layout_independent(spark):
    a, w = synthetic_frame(spark, 500, 4, num_partitions=1)
    b, _ = synthetic_frame(spark, 500, 4, num_partitions=6)
    pa_ = a.orderBy("id").toPandas()
    pb_ = b.orderBy("id").toPandas()
    pd.testing.assert_frame_equal(pa_, pb_)
    np.testing.assert_array_equal(w, true_weights(4, 42))
    assert abs(pa_["x1"].mean()) < 0.2 and abs(pa_["x1"].std() - 1) < 0.15
    resid = pa_["y"] - (w[0] + pa_[["x1", "x2", "x3", "x4"]].to_numpy() @ w[1:])
    assert abs(resid.std() - 0.1) < 0.02


def test_make_synthetic_regression_split(spark):
    train, test, w = make_synthetic_regression(spark, 1000, 2, method="randn", num_partitions=2)
    assert train.count() + test.count() == 1000 and len(w) == 3
    with pytest.raises(ValueError):
        make_synthetic_regression(spark, 1, 2)
    with pytest.raises(ValueError):
        make_synthetic_regression(spark, 10, 0)
