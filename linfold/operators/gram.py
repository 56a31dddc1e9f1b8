"""Gradient, loss and sufficient statistics of squared loss (G1-G5).

Two distributed kernels, both a single partial/final aggregation (map-side combine, then
d+2 or (d+2)^2 numbers per partition cross the shuffle; the driver receives only those):

* ``gradient_partials`` -- the reference's chunk gradient and its row-weighted combine:
  for weights w it returns n, sum(e), sum(e*x_j) and sum(e^2) with e = Zw - y.
* ``gram_stats`` -- n, means and *centred* co-moment sums of [x, y]. Built from data
  shifted by one sample row, so large offsets do not cancel digits, then centred exactly
  on the driver.

Narrow designs: plain SQL sums (Catalyst, whole-stage codegen). Wide ones: ``mapInArrow`` with a
NumPy block product per Arrow batch; the partitions' partial vectors are cut into fixed-size blocks
and summed per block in two levels. The width decides only which is faster: both reject rows with
NULL, NaN or infinite values by the same count and the same error.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import linear_combination, quote

# SQL sums up to this many features: (d+1)(d+2)/2 + d + 3 aggregate buffers stay below
# spark.sql.codegen.maxFields (100), so the aggregate keeps whole-stage codegen; above it the
# Arrow block product wins (measured: 1M rows, d=10 -> 0.69 s SQL vs 0.47 s Arrow).
SQL_MAX_FEATURES = 8
# up to this many features Spark's own stable co-moment aggregates (avg / covar_pop, Chan-style
# merges) fit in whole-stage codegen and need no shift row: one job instead of two
# (1M rows, d=3: 0.17 s vs 0.27-0.40 s, equal to 1e-13)
COVAR_MAX_FEATURES = 5
# the gradient partials carry only d + 3 buffers, but literal weights mean a fresh codegen
# compile per epoch; the Arrow pass overtakes from about d = 12 (1M rows: d=10 0.42 s SQL vs
# 0.45 s Arrow, d=20 0.75 s vs 0.55 s)
PARTIALS_SQL_MAX_FEATURES = 12


def _x(c: str) -> Column:
    return F.col(quote(c)).cast("double")


def _check_weights(features: list[str], weights) -> np.ndarray:
    w = np.asarray(weights, dtype=float).reshape(-1)
    if w.shape[0] != len(features) + 1:
        raise ValueError("weights length must equal the number of features plus the intercept.")
    return w


BLOCK = 16_384


def vector_blocks(vec: np.ndarray) -> pa.RecordBatch:
    """A partition's partial vector as rows (blk, vals) of at most ``BLOCK`` numbers."""
    ids, vals = [], []
    for blk, start in enumerate(range(0, max(len(vec), 1), BLOCK)):
        ids.append(blk)
        vals.append(vec[start:start + BLOCK].tolist())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()),
                                       pa.array(vals, pa.list_(pa.float64()))],
                                      names=["blk", "vals"])


BLOCK_SCHEMA = "blk int, vals array<double>"


MERGE_WAYS = 32   # partial rows of a block are first summed in this many groups
NARROW = 1024     # vectors up to this width need no first level: one task adds them up as they come


def sum_blocks(parts: DataFrame, width: int) -> np.ndarray:
    """Element-wise sum of the partial vectors of all partitions. Wide ones: per block and group of
    partitions, then per block, so no task gets a wide block of every partition. The driver
    receives ``width`` numbers."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    vectors = parts.select("blk", array_to_vector("vals").alias("v"),
                           F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)).alias("way"))
    if width > NARROW:
        vectors = vectors.groupBy("blk", "way").agg(Summarizer.sum(F.col("v")).alias("v"))
    rows = vectors.groupBy("blk").agg(Summarizer.sum(F.col("v")).alias("s")).collect()
    out = np.zeros(width)
    for r in rows:
        block = r["s"].toArray()
        out[r["blk"] * BLOCK:r["blk"] * BLOCK + len(block)] = block
    return out


def _is_null(columns: list[str]) -> Column:
    return functools.reduce(lambda a, b: a | b, [_x(c).isNull() for c in columns], F.lit(False))


def _is_odd(columns: list[str]) -> Column:
    """NaN or infinite in a column, and no NULL in any."""
    odd = [F.isnan(_x(c)) | (F.abs(_x(c)) == F.lit(float("inf"))) for c in columns]
    return ~_is_null(columns) & functools.reduce(lambda a, b: a | b, odd, F.lit(False))


def _row_counts(columns: list[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.count_if(_is_null(columns)).alias("nulls"),
            F.count_if(_is_odd(columns)).alias("odd")]


def _rejected(nulls: int, odd: int) -> str:
    return (f"{nulls} rows hold NULL and {odd} rows hold NaN or infinite values in a feature or the target.")


def _check_rows(n: int, nulls: int, odd: int) -> None:
    if n == 0:
        raise ValueError("At least one row is required.")
    if nulls or odd:
        raise ValueError(_rejected(nulls, odd))


def usable_rows(df: DataFrame, features: list[str], target: str, invalid: str = "error") -> DataFrame:
    """``df``, with ``invalid="skip"`` without the rows that hold NULL, NaN or infinite values in a
    feature or the target; with ``"error"`` these are rejected by the aggregate that meets them."""
    if invalid not in ("error", "skip"):
        raise ValueError("invalid must be 'error' or 'skip'.")
    columns = [*features, target]
    return df.where(~_is_null(columns) & ~_is_odd(columns)) if invalid == "skip" else df


def _guarded(value: Column) -> Column:
    """A lazily computed value that raises if the aggregate met rows that must be rejected."""
    message = F.concat(F.col("nulls").cast("string"), F.lit(" rows hold NULL and "), F.col("odd").cast("string"),
                       F.lit(" rows hold NaN or infinite values in a feature or the target."))
    return (F.when(F.col("nulls") + F.col("odd") > 0, F.raise_error(message).cast("double"))
            .when(F.col("n") == 0, F.raise_error(F.lit("At least one row is required.")).cast("double"))
            .otherwise(value))


def _arrow_sum(df: DataFrame, columns: list[str], kernel, width: int, adds: bool = False) -> np.ndarray:
    """n, NULL rows, NaN/infinite rows and the sum of ``kernel(block)`` (``width`` numbers) over the
    other rows, per partition in Arrow. With ``adds`` the kernel adds to its second argument."""

    def run(batches):
        from linfold.operators.blocks import valid_blocks

        acc, counts = np.zeros(3 + width), np.zeros(3, dtype=np.int64)
        for block in valid_blocks(batches, counts):
            if adds:
                kernel(block, acc[3:])
            else:
                acc[3:] += kernel(block)
        acc[:3] = counts
        if acc[0]:
            yield vector_blocks(acc)

    from linfold.session import ship_package
    ship_package(df.sparkSession)
    frame = df.select(*[_x(c).alias(f"c{i}") for i, c in enumerate(columns)],
                      _is_null(columns).cast("double").alias("is_null"))
    total = sum_blocks(frame.mapInArrow(run, BLOCK_SCHEMA), 3 + width)
    _check_rows(*[int(round(v)) for v in total[:3]])
    return np.concatenate([total[:1], total[3:]])


@dataclass(frozen=True)
class GradientPartial:
    """Combined chunk results at one weight vector."""
    n: int
    sum_e: float
    sum_ex: np.ndarray
    sse: float

    @property
    def grad_sum(self) -> np.ndarray:
        """2 * Z^T e, intercept first (the reference's per-chunk ``grad_sum``)."""
        return 2.0 * np.concatenate([[self.sum_e], self.sum_ex])


def _residual(features: list[str], target: str, w: np.ndarray) -> Column:
    return linear_combination(w[0], w[1:], [_x(c) for c in features]) - _x(target)


def _partial_columns(features: list[str], target: str, w: np.ndarray) -> list[Column]:
    e = _residual(features, target, w)
    return (_row_counts([*features, target]) + [F.sum(e).alias("se")]
            + [F.sum(e * _x(c)).alias(f"sx{j}") for j, c in enumerate(features)]
            + [F.sum(e * e).alias("sse")])


def gradient_partials(df: DataFrame, features: list[str], target: str, weights,
                      method: str = "auto") -> GradientPartial:
    w = _check_weights(features, weights)
    d = len(features)
    if method == "sql" or (method == "auto" and d <= PARTIALS_SQL_MAX_FEATURES):
        row = df.agg(*_partial_columns(features, target, w)).collect()[0]
        _check_rows(row["n"], row["nulls"], row["odd"])
        return GradientPartial(int(row["n"]), float(row["se"]),
                               np.array([float(row[f"sx{j}"]) for j in range(d)]),
                               float(row["sse"]))

    def kernel(block):
        x, y = block[:, :d], block[:, d]
        e = w[0] + x @ w[1:] - y
        return np.concatenate([[e.sum()], x.T @ e, [e @ e]])

    v = _arrow_sum(df, [*features, target], kernel, d + 2)
    return GradientPartial(int(round(v[0])), float(v[1]), v[2:2 + d], float(v[2 + d]))


def penalty_diagonal(size: int, alpha: float) -> np.ndarray:
    """The ridge term as a diagonal over the weights: alpha for each, 0 for the intercept. The term
    is sum(diagonal * w**2), its gradient 2 * diagonal * w."""
    if alpha < 0:
        raise ValueError("alpha must not be negative.")
    return np.concatenate([[0.0], np.full(size - 1, float(alpha))])


def compute_gradient(df: DataFrame, features: list[str], target: str, weights,
                     alpha: float = 0.0) -> np.ndarray:
    """Full-batch gradient of mean squared error (+ ridge), row-weighted over partitions."""
    w = _check_weights(features, weights)
    ridge = 2.0 * penalty_diagonal(len(w), alpha) * w
    p = gradient_partials(df, features, target, w)
    return p.grad_sum / p.n + ridge


def compute_loss(df: DataFrame, features: list[str], target: str, weights,
                 alpha: float = 0.0) -> float:
    """mean((Zw - y)^2) + alpha * sum_{j>=1} w_j^2."""
    w = _check_weights(features, weights)
    ridge = float(penalty_diagonal(len(w), alpha) @ w ** 2)
    p = gradient_partials(df, features, target, w)
    return p.sse / p.n + ridge


def chunk_gradients(df: DataFrame, features: list[str], target: str, weights, chunk: Column,
                    invalid: str = "error") -> DataFrame:
    """One row per chunk: chunk, n, ``g0`` .. ``gd`` (the chunk's gradient sums 2 Z'(Zw - y),
    intercept first). ``chunk`` is any expression of the row (a hash of its key, or
    ``spark_partition_id()``); rows are not moved, only the chunks' sums are."""
    w = _check_weights(features, weights)
    sums = (usable_rows(df, features, target, invalid).groupBy(chunk.alias("chunk"))
            .agg(*_partial_columns(features, target, w)))
    two = F.lit(2.0)
    return sums.select("chunk", "n", _guarded(two * F.col("se")).alias("g0"),
                       *[_guarded(two * F.col(f"sx{j}")).alias(f"g{j + 1}") for j in range(len(features))])


def combine_chunks(chunks: DataFrame, features: list[str], weights=None, alpha: float = 0.0) -> DataFrame:
    """The gradient (idx, name, gradient) from ``chunk_gradients`` rows, each weighted by its rows."""
    size = len(features) + 1
    w = np.zeros(size) if weights is None else _check_weights(features, weights)
    ridge = 2.0 * penalty_diagonal(size, alpha) * w
    total = chunks.agg(F.sum("n").alias("n"), *[F.sum(f"g{j}").alias(f"g{j}") for j in range(size)])
    names = ["intercept", *features]
    return total.select(F.explode(F.array(*[
        F.struct(F.lit(j).alias("idx"), F.lit(names[j]).alias("name"),
                 (F.col(f"g{j}") / F.col("n") + F.lit(float(ridge[j]))).alias("gradient"))
        for j in range(size)])).alias("g")).select("g.*")


def gradient_frame(df: DataFrame, features: list[str], target: str, weights,
                   alpha: float = 0.0, invalid: str = "error") -> DataFrame:
    """Lazy one-aggregate form of ``compute_gradient``: rows (idx, name, gradient)."""
    one = chunk_gradients(df, features, target, weights, F.lit(0), invalid)
    return combine_chunks(one, features, weights, alpha)


def gram_sums_frame(df: DataFrame, features: list[str], target: str,
                    y_name: str = "y") -> DataFrame:
    """Lazy raw Gram sums as rows (row_name, col_name, value): Z^T Z (upper triangle,
    intercept first), Z^T y and y^T y, each a plain sum of products in one aggregate -- the
    chunk sums combined, exact whenever the products are exact (e.g. integer data).
    Training uses the centred statistics of ``gram_stats`` instead."""
    names = ["intercept"] + list(features)
    z = [F.lit(1.0)] + [_x(c) for c in features]
    y = _x(target)
    entries = []
    for i in range(len(z)):
        for j in range(i, len(z)):
            entries.append((names[i], names[j], F.sum(z[i] * z[j])))
    entries += [(names[i], y_name, F.sum(z[i] * y)) for i in range(len(z))]
    entries.append((y_name, y_name, F.sum(y * y)))
    agg = df.agg(*_row_counts([*features, target]), *[e[2].alias(f"s{k}") for k, e in enumerate(entries)])
    rows = [F.struct(F.lit(r).alias("row_name"), F.lit(c).alias("col_name"),
                     _guarded(F.col(f"s{k}")).alias("value")) for k, (r, c, _) in enumerate(entries)]
    return agg.select(F.explode(F.array(*rows)).alias("g")).select("g.*")


def loss_frame(df: DataFrame, features: list[str], target: str, weights,
               alpha: float = 0.0, invalid: str = "error") -> DataFrame:
    """Lazy ``compute_loss``: one row (n, mse, penalty, loss)."""
    w = _check_weights(features, weights)
    ridge = float(penalty_diagonal(len(w), alpha) @ w ** 2)
    e = _residual(features, target, w)
    agg = usable_rows(df, features, target, invalid).agg(*_row_counts([*features, target]), F.avg(e * e).alias("mse"))
    mse = _guarded(F.col("mse"))
    return agg.select("n", mse.alias("mse"), F.lit(ridge).alias("penalty"), (mse + F.lit(ridge)).alias("loss"))


@dataclass(frozen=True)
class GramStats:
    """n, means and centred co-moment sums of the design [x_1..x_d] and target y."""
    features: tuple[str, ...]
    n: int
    mean_x: np.ndarray
    mean_y: float
    cxx: np.ndarray
    cxy: np.ndarray
    cyy: float

    @property
    def d(self) -> int:
        return len(self.features)

    def raw(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Uncentred Z^T Z (intercept first), Z^T y and y^T y."""
        n, mx, my = self.n, self.mean_x, self.mean_y
        g = np.empty((self.d + 1, self.d + 1))
        g[0, 0] = n
        g[0, 1:] = g[1:, 0] = n * mx
        g[1:, 1:] = self.cxx + n * np.outer(mx, mx)
        b = np.concatenate([[n * my], self.cxy + n * mx * my])
        return g, b, float(self.cyy + n * my * my)


def _shift_row(df: DataFrame, columns: list[str]) -> np.ndarray:
    rows = df.select(*[_x(c) for c in columns]).limit(1).collect()
    if not rows:
        raise ValueError("At least one row is required.")
    return np.array([0.0 if (v is None or not np.isfinite(v)) else float(v) for v in rows[0]])


def _symmetric(k: int, value) -> np.ndarray:
    out = np.empty((k, k))
    for i in range(k):
        for j in range(i, k):
            out[i, j] = out[j, i] = value(i, j)
    return out


def gram_stats(df: DataFrame, features: list[str], target: str,
               method: str = "auto") -> GramStats:
    """One data pass (plus a one-row peek for the shift in all but the narrowest form). A row with
    NULL, NaN or an infinite value in any column is an error."""
    features = list(features)
    cols = [*features, target]
    k, d = len(cols), len(features)
    if method == "auto":
        method = "covar" if d <= COVAR_MAX_FEATURES else "sql" if d <= SQL_MAX_FEATURES else "arrow"
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    if method == "covar":
        row = df.agg(*_row_counts(cols), *[F.avg(_x(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.covar_pop(_x(cols[i]), _x(cols[j])).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]
        n = row["n"]
        _check_rows(n, row["nulls"], row["odd"])
        mean = np.array([float(row[f"m{i}"]) for i in range(k)])
        centred = _symmetric(k, lambda i, j: float(row[f"c{i}_{j}"]) * n)
    else:
        s = _shift_row(df, cols)
        if method == "sql":
            z = [_x(c) - F.lit(float(s[i])) for i, c in enumerate(cols)]
            row = df.agg(*_row_counts(cols), *[F.sum(z[i]).alias(f"s{i}") for i in range(k)],
                         *[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect()[0]
            n = row["n"]
            _check_rows(n, row["nulls"], row["odd"])
            sums = np.array([float(row[f"s{i}"]) for i in range(k)])
            prod = _symmetric(k, lambda i, j: float(row[f"p{i}_{j}"]))
        else:
            def kernel(block):
                shifted = block - s
                return np.concatenate([shifted.sum(axis=0), (shifted.T @ shifted).reshape(-1)])

            v = _arrow_sum(df, cols, kernel, k + k * k)
            n, sums, prod = int(round(v[0])), v[1:1 + k], v[1 + k:].reshape(k, k)
        mean = s + sums / n
        centred = prod - np.outer(sums, sums) / n
    return GramStats(tuple(features), int(n), mean[:d], float(mean[d]), centred[:d, :d],
                     centred[:d, d], float(centred[d, d]))
