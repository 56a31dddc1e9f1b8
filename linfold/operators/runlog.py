"""Run statistics over a run-log table (R1), speedup/efficiency (R2), report series (R3).

A run log has one row per timed fit: ``model, implementation, processes, repeat, seconds``
(``processes`` NULL for library baselines). Everything here is grouped aggregation over
that table, so it scales with the number of logged runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.select import Ranked
from linfold.session import materialize

RUN_KEYS = ("model", "implementation", "processes")
RESULT_COLUMNS = ("model", "implementation", "processes", "training_time", "median_time",
                  "min_time", "max_time", "std_time", "speedup", "efficiency",
                  "MSE", "RMSE", "MAE", "R2")


def run_stats(log: DataFrame, keys: tuple[str, ...] | list[str] = RUN_KEYS,
              seconds: str = "seconds") -> DataFrame:
    """Per run: exact median, min, max, population std (0.0 for one repeat) of the times;
    ``training_time`` is the median. Runs without any time are left out.

    The log is read once, into counted values per run; all figures follow from these. The result,
    a row per run, is checkpointed, so what is built on it does not compute it again."""
    keys = list(keys)
    ranked = Ranked(log, [seconds], keys)
    try:
        counted, groups = ranked.counted, ranked.groups
        basic = counted.groupBy(*groups).agg(
            F.min("v").alias("min_time"), F.max("v").alias("max_time"), F.sum("n").alias("rows"),
            (F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean"))
        off = counted.alias("a").join(basic.alias("b"), ranked.match(groups)).select(
            *[F.col(f"b.{g}") for g in groups], "min_time", "max_time", "rows",
            (F.col("n") * F.pow(F.col("v") - F.col("mean"), 2)).alias("square"))
        spread = off.groupBy(*groups, "min_time", "max_time", "rows").agg(F.sum("square").alias("square"))
        joined = spread.alias("a").join(ranked.quantiles(0.5).alias("b"), ranked.match(groups)).select(
            *[F.col(f"a.{g}").alias(k) for g, k in zip(groups, keys)], F.col("q").alias("training_time"),
            F.col("q").alias("median_time"), "min_time", "max_time",
            F.sqrt(F.col("square") / F.col("rows")).alias("std_time"))
        return materialize(joined, "checkpoint")
    finally:
        ranked.release()


def add_speedup(stats: DataFrame, baseline: dict[str, object],
                time_col: str = "median_time", processes: str = "processes") -> DataFrame:
    """speedup = T_baseline / T; efficiency = speedup by the processes per process of the baseline
    (its ``processes``, 1 if not named). Baseline row 1.0 / 1.0; NULL where ``processes`` is NULL
    (library baselines). The baseline time is a scalar subquery over the one matching row."""
    is_base = F.lit(True)
    for k, v in baseline.items():
        is_base = is_base & (F.col(quote(k)) == F.lit(v))
    base_time = stats.filter(is_base).agg(F.max(quote(time_col))).scalar()
    p = F.col(quote(processes)).cast("double")
    ways = p / F.lit(float(baseline.get(processes, 1)))
    speedup = (F.when(is_base, F.lit(1.0)).when(p.isNull(), F.lit(None).cast("double"))
               .otherwise(base_time / F.col(quote(time_col))))
    return (stats.withColumn("speedup", speedup)
            .withColumn("efficiency", F.when(is_base, F.lit(1.0)).otherwise(F.col("speedup") / ways)))


def run_label(implementation: str = "implementation", processes: str = "processes"):
    """``impl (kp)``, or ``impl`` when processes is NULL."""
    p = F.col(quote(processes))
    return F.when(p.isNull(), F.col(quote(implementation)).cast("string")).otherwise(
        F.concat(F.col(quote(implementation)).cast("string"), F.lit(" ("),
                 p.cast("bigint").cast("string"), F.lit("p)")))


def report_series(results: DataFrame, metric: str, implementation: str = "implementation",
                  processes: str = "processes") -> DataFrame:
    """The table behind a line chart: NULL rows dropped, per implementation by processes."""
    return (results.dropna(subset=[metric, processes])
            .select(F.col(quote(implementation)).alias("implementation"),
                    F.col(quote(processes)).alias("processes"),
                    run_label(implementation, processes).alias("label"),
                    F.lit(metric).alias("metric"),
                    F.col(quote(metric)).cast("double").alias("value"))
            .orderBy("implementation", "processes"))


def loss_history_frame(spark: SparkSession, histories: dict[str, list[float]]) -> DataFrame:
    """Loss histories as a long table (run, epoch from 1, loss)."""
    rows = [(run, e + 1, float(v)) for run, hist in histories.items() for e, v in enumerate(hist)]
    return spark.createDataFrame(rows, "run string, epoch int, loss double")
