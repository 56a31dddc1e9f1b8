"""Gram statistics of a prepared design built from grouped counts (one-hot aware).

The dense Gram costs n * d^2 per pass, and every one-hot category adds a column to d.
But one-hot indicators of one column are mutually exclusive, so all categorical blocks of
the Gram are grouped aggregates of the *raw* columns:

* numeric x numeric: sums of products of the standardised numeric columns (one pass);
* category v of column c x numeric u (or target y): sum of u over the rows with c = v;
* categories of one column: the diagonal counts;
* categories of two columns: co-occurrence counts, ``groupBy(c, c')``.

Pass 2 stacks every column and every column pair (``explode`` of small structs) into one
``groupBy(set, key1, key2)`` with map-side combine, so a hot category costs nothing. The
cost is linear in rows and independent of the number of categories; the driver receives
at most sum |V_c| + sum |V_c| * |V_c'| rows -- no more than the d x d Gram it must hold
anyway. For designs too wide for that, ``fit_gd(solver="per_epoch")`` needs only ``onehot_partials``,
d + 1 numbers a pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.gram import GradientPartial, GramStats, _check_rows, _row_counts, gram_stats
from linfold.operators.preprocess import PreprocessorModel, category_value


def onehot_gram_stats(raw: DataFrame, model: PreprocessorModel, target: str) -> GramStats:
    """GramStats over ``model.feature_names`` (intercept implicit) and ``target``, from the
    untransformed table ``raw`` (e.g. the kept raw train split of a prepare)."""
    names = model.feature_names
    index = model.positions
    num = list(model.numeric)
    cats = list(model.categorical)
    d = len(names)
    u_cols = [f"_u{j}" for j in range(len(num))]
    frame = raw.select(*[model.numeric_expr(c).alias(u) for c, u in zip(num, u_cols)],
                       *[F.coalesce(category_value(c, raw.schema[c].dataType),
                                    F.lit(model.modes[c])).alias(f"_c{i}")
                         for i, c in enumerate(cats)],
                       F.col(quote(target)).cast("double").alias("_y"))

    # pass 1: numeric block and target, shifted and centred exactly (see gram.py)
    base = gram_stats(frame, u_cols, "_y")
    n = base.n
    if not cats:
        return GramStats(tuple(names), n, base.mean_x, base.mean_y, base.cxx, base.cxy, base.cyy)

    # pass 2: per category and per pair of categories: count, sum of each numeric, sum of y
    entries = [F.struct(F.lit(i).alias("s"), F.col(f"_c{i}").alias("k1"),
                        F.lit(None).cast("string").alias("k2")) for i in range(len(cats))]
    pairs = [(a, b) for a in range(len(cats)) for b in range(a + 1, len(cats))]
    entries += [F.struct(F.lit(len(cats) + p).alias("s"), F.col(f"_c{a}").alias("k1"),
                         F.col(f"_c{b}").alias("k2")) for p, (a, b) in enumerate(pairs)]
    stacked = frame.select(*u_cols, "_y", F.explode(F.array(*entries)).alias("e"))
    grouped = stacked.groupBy(F.col("e.s").alias("s"), F.col("e.k1").alias("k1"),
                              F.col("e.k2").alias("k2")).agg(
        F.count(F.lit(1)).alias("cnt"), *[F.sum(u).alias(u) for u in u_cols],
        F.sum("_y").alias("sy"))
    rows = grouped.collect()

    # raw (uncentred) sums over the categorical indicators
    sums = np.zeros(d)             # sum of each feature
    cross = np.zeros((d, d))       # sum of products, categorical rows/columns only
    sxy = np.zeros(d)              # sum of feature * y
    sums[:len(num)] = base.mean_x * n
    for r in rows:
        s = r["s"]
        if s < len(cats):
            c = cats[s]
            i = index.get((c, r["k1"]))
            if i is None:
                continue
            sums[i] = r["cnt"]
            cross[i, i] = r["cnt"]
            sxy[i] = r["sy"]
            for j, u in enumerate(u_cols):
                cross[i, j] = cross[j, i] = r[u]
        else:
            a, b = pairs[s - len(cats)]
            i, j = index.get((cats[a], r["k1"])), index.get((cats[b], r["k2"]))
            if i is None or j is None:
                continue
            cross[i, j] = cross[j, i] = r["cnt"]
    mean_x = sums / n
    cxx = cross - np.outer(sums, sums) / n
    k = len(num)
    cxx[:k, :k] = base.cxx                      # the exactly centred numeric block
    sy = base.mean_y * n
    cxy = sxy - sums * sy / n
    cxy[:k] = base.cxy
    return GramStats(tuple(names), n, mean_x, base.mean_y, cxx, cxy, base.cyy)


def onehot_partials(raw: DataFrame, model: PreprocessorModel, target: str,
                    weights) -> GradientPartial:
    """Residual partials (n, sum e, sum e*x_j, sum e^2) at ``weights`` for the prepared
    design, from the raw columns: the numeric part by sums, the one-hot part by one
    stacked ``groupBy(column, value)`` of the residual. Linear in rows, independent of
    the number of categories."""
    names = model.feature_names
    index = model.positions
    num, cats = list(model.numeric), list(model.categorical)
    e = model.prediction_column(weights, raw.schema) - F.col(quote(target)).cast("double")
    frame = raw.select(*[model.numeric_expr(c).alias(f"_u{j}") for j, c in enumerate(num)],
                       *[model.filled_category(c, raw.schema[c].dataType).alias(f"_c{i}")
                         for i, c in enumerate(cats)], e.alias("_e"))
    row = frame.agg(*_row_counts(["_e"]), F.sum("_e").alias("se"),
                    F.sum(F.col("_e") * F.col("_e")).alias("sse"),
                    *[F.sum(F.col("_e") * F.col(f"_u{j}")).alias(f"su{j}")
                      for j in range(len(num))]).collect()[0]
    _check_rows(row["n"], row["nulls"], row["odd"])
    n = int(row["n"])
    sum_ex = np.zeros(len(names))
    for j in range(len(num)):
        sum_ex[j] = float(row[f"su{j}"])
    if cats:
        stacked = frame.select("_e", F.explode(F.array(*[
            F.struct(F.lit(i).alias("s"), F.col(f"_c{i}").alias("k"))
            for i in range(len(cats))])).alias("g"))
        for r in stacked.groupBy(F.col("g.s").alias("s"), F.col("g.k").alias("k")).agg(
                F.sum("_e").alias("se")).collect():
            i = index.get((cats[r["s"]], r["k"]))
            if i is not None:
                sum_ex[i] = float(r["se"])
    return GradientPartial(n, float(row["se"]), sum_ex, float(row["sse"]))
