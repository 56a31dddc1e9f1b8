"""Least squares (B1) and ridge (B2).

``fit_ols`` / ``fit_ridge`` read the data once and solve from a tree of QR factors (``qr.py``).
``solve_centred`` solves the centred normal equations of Gram statistics that are there anyway: for
the point around which gradient descent measures its loss (any point near the minimum will do), and
for one-hot designs, whose statistics come from grouped counts. There features are first brought to
one scale, and a design of lower rank (full one-hot plus intercept) gets the minimum-norm solution.
Ridge minimises SSE + alpha*||w||^2 (the library scale, which equals the gradient-descent objective
MSE + alpha'*||w||^2 at alpha' = alpha / n).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from linfold.operators.gram import GramStats
from linfold.operators.qr import Factor, r_factor, solve_factor


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    intercept: float
    coef: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        """Intercept first, as everywhere in this package."""
        return np.concatenate([[self.intercept], self.coef])

    def weights_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(0, "intercept", float(self.intercept))] + [
            (j + 1, f, float(v)) for j, (f, v) in enumerate(zip(self.features, self.coef))]
        return spark.createDataFrame(rows, "idx int, name string, weight double")


def least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum-norm solution of a symmetric positive semi-definite system whose rank is judged
    after scaling its diagonal to ones."""
    if a.size == 0:
        return np.zeros(0)
    size = np.sqrt(np.maximum(np.diag(a), 0.0))
    used = size > 0
    out = np.zeros(len(b))
    if not used.any():
        return out
    size = size[used]
    scaled = a[np.ix_(used, used)] / np.outer(size, size)
    vals, vecs = np.linalg.eigh(scaled)
    # A null direction of m features has an eigenvalue of rounding size, about m times 1e-16. The
    # normal equations cannot tell features from each other that differ by less than its root;
    # fit_ols can.
    keep = vals > 8 * len(vals) * np.finfo(float).eps * vals.max()
    solution = vecs[:, keep] @ ((vecs[:, keep].T @ (b[used] / size)) / vals[keep]) / size
    if not keep.all():
        # Any solution plus the null space; the one with the least norm is orthogonal to it.
        null = vecs[:, ~keep] / size[:, None]
        basis, _ = np.linalg.qr(null)
        solution = solution - basis @ (basis.T @ solution)
    out[used] = solution
    return out


def solve_centred(stats: GramStats, alpha: float = 0.0) -> LinearModel:
    if alpha < 0:
        raise ValueError("alpha must not be negative.")
    if alpha == 0:
        coef = least_squares(stats.cxx, stats.cxy)
    else:
        coef = np.linalg.solve(stats.cxx + alpha * np.eye(stats.d), stats.cxy)
    intercept = stats.mean_y - float(stats.mean_x @ coef) if stats.d else stats.mean_y
    return LinearModel(stats.features, float(intercept), np.asarray(coef, dtype=float))


def fit_ols(df: DataFrame, features: list[str], target: str, factor: Factor | None = None) -> LinearModel:
    """Least squares of least norm. ``factor``: an ``r_factor`` that is there already."""
    return _from_factor(factor or r_factor(df, features, target), 0.0)


def fit_ridge(df: DataFrame, features: list[str], target: str, alpha: float = 1.0,
              factor: Factor | None = None) -> LinearModel:
    return _from_factor(factor or r_factor(df, features, target), alpha)


def _from_factor(factor: Factor, alpha: float) -> LinearModel:
    intercept, coef = solve_factor(factor, alpha)
    return LinearModel(factor.features, intercept, coef)
