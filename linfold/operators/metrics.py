"""Regression metrics (M1-M5) as one aggregate pass, optionally grouped.

R2 = 1 - SSR/SST, and 0.0 when SST = 0 (constant target). SST is ``var_pop(y) * n``,
which Spark computes with a stable merge and which is exactly 0 for a constant column.
A NULL in the target or the prediction raises at execution time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote

METRIC_NAMES = ("MSE", "RMSE", "MAE", "R2")


def _metric_aggs(y: Column, p: Column, suffix: str = "") -> list[Column]:
    e = p - y
    return [
        F.count(F.lit(1)).alias(f"n{suffix}"),
        F.count(F.when(y.isNull() | p.isNull() | F.isnan(y) | F.isnan(p), 1)).alias(f"bad{suffix}"),
        F.avg(e * e).alias(f"mse{suffix}"),
        F.avg(F.abs(e)).alias(f"mae{suffix}"),
        F.sum(e * e).alias(f"ssr{suffix}"),
        (F.var_pop(y) * F.count(y)).alias(f"sst{suffix}"),
    ]


def _metric_values(suffix: str = "") -> list[Column]:
    bad = F.col(f"bad{suffix}")
    mse = (F.when(bad > 0, F.raise_error(F.lit("target and prediction must not hold NULL/NaN")).cast("double"))
           .when(F.col(f"n{suffix}") == 0, F.raise_error(F.lit("evaluation needs at least one row")).cast("double"))
           .otherwise(F.col(f"mse{suffix}")))
    sst = F.col(f"sst{suffix}")
    r2 = F.when(sst == 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.col(f"ssr{suffix}") / sst)
    return [mse.alias("MSE"), F.sqrt(mse).alias("RMSE"), F.col(f"mae{suffix}").alias("MAE"),
            r2.alias("R2")]


def evaluate(df: DataFrame, target: str, prediction: str = "prediction",
             by: list[str] | None = None) -> DataFrame:
    """MSE, RMSE, MAE and R2 of ``prediction`` against ``target`` (per group with ``by``)."""
    by = list(by or [])
    y, p = F.col(quote(target)).cast("double"), F.col(quote(prediction)).cast("double")
    grouped = df.groupBy(*[quote(b) for b in by]) if by else df.groupBy()
    agg = grouped.agg(*_metric_aggs(y, p))
    return agg.select(*[quote(b) for b in by], *_metric_values())


def evaluate_many(df: DataFrame, target: str, predictions: dict[str, Column]) -> DataFrame:
    """Metrics of several prediction columns in ONE scan; one output row per model name."""
    y = F.col(quote(target)).cast("double")
    aggs = []
    for i, p in enumerate(predictions.values()):
        aggs += _metric_aggs(y, p.cast("double"), f"_{i}")
    agg = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("name"), *_metric_values(f"_{i}"))
            for i, name in enumerate(predictions)]
    return agg.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def evaluate_model(df: DataFrame, target: str, prediction: str = "prediction") -> dict[str, float]:
    row = evaluate(df, target, prediction).collect()[0]
    return {k: float(row[k]) for k in METRIC_NAMES}
