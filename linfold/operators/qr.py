"""Least squares by a tree of QR factors (B1, B2).

Every task reduces its rows of [1, x, y] to the triangular factor R of a QR decomposition: the
factor of the rows seen so far, stacked on the next block, is decomposed again. Factors of
different tasks combine in the same way in any order, so they are merged in a tree (``MERGE_WAYS``
tasks, then one); each is at most (d + 2)^2 numbers, and the driver receives one. The data is read
once. Unlike the normal equations, which square the condition of a design, R keeps it: features
that differ from each other by 1e-8 of their size still have weights of their own.

The column of ones comes first, so R without its first row belongs to the centred design: the
intercept is never penalised and large offsets cost no digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.operators.blocks import numeric_selection, valid_blocks
from linfold.operators.gram import MERGE_WAYS, _check_rows
from linfold.session import ship_package

FACTOR_SCHEMA = "way int, n long, nulls long, odd long, r binary"
BLOCK_ROWS = 4096


@dataclass(frozen=True)
class Factor:
    """R of [1, x, y] over ``n`` rows (intercept first, target last)."""
    features: tuple[str, ...]
    n: int
    r: np.ndarray

    @property
    def means(self) -> np.ndarray:
        """Means of x and y."""
        return self.r[0, 1:] / self.r[0, 0]

    @property
    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        """A triangular matrix and a vector with the least-squares problem of the centred design."""
        d = len(self.features)
        return self.r[1:d + 1, 1:d + 1], self.r[1:d + 1, d + 1]


def _record(way: int, counts: np.ndarray, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([way], pa.int32()), *[pa.array([int(c)], pa.int64()) for c in counts],
         pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], ["way", "n", "nulls", "odd", "r"])


def stacked(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The factor of the rows behind ``r`` and of ``rows``."""
    return np.linalg.qr(np.concatenate((r, rows)), mode="r")


def r_factor(df: DataFrame, features: list[str], target: str) -> Factor:
    """The factor of ``df``. Rows with NULL, NaN or infinite values are an error."""
    ship_package(df.sparkSession)
    features = list(features)
    k = len(features) + 2

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, r = np.zeros(3, dtype=np.int64), np.zeros((0, k))
        for block in valid_blocks(batches, counts):
            for at in range(0, len(block), BLOCK_ROWS):
                rows = block[at:at + BLOCK_ROWS]
                r = stacked(r, np.column_stack([np.ones(len(rows)), rows]))
        if counts[0]:
            yield _record(TaskContext.get().partitionId(), counts, r)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, r = np.zeros(3, dtype=np.int64), np.zeros((0, k))
        for batch in batches:
            for row in batch.to_pylist():
                counts += row["n"], row["nulls"], row["odd"]
                r = stacked(r, np.frombuffer(row["r"], dtype=np.float64).reshape(-1, k))
        if counts[0]:
            yield _record(TaskContext.get().partitionId(), counts, r)

    factors = numeric_selection(df, [*features, target]).mapInArrow(local, FACTOR_SCHEMA)
    for ways in (MERGE_WAYS, 1):
        factors = factors.repartitionById(ways, F.pmod("way", F.lit(ways))).mapInArrow(merged, FACTOR_SCHEMA)
    row = factors.first()
    if row is None:
        _check_rows(0, 0, 0)
    _check_rows(row["n"], row["nulls"], row["odd"])
    r = np.zeros((k, k))
    found = np.frombuffer(row["r"], dtype=np.float64).reshape(-1, k)
    r[:len(found)] = found
    return Factor(tuple(features), row["n"], r)


def min_norm(a: np.ndarray, b: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The least-squares solution of least norm. Columns are first brought to one size, so that the
    rank does not depend on units; a direction counts as missing only below the rounding of the
    factor itself (a few units of the last digit per column), and a column as constant only below
    the rounding of its ``whole`` size, offset included."""
    size = np.sqrt((a * a).sum(axis=0))
    rounding = 8 * a.shape[1] * np.finfo(float).eps
    used = size > rounding * whole
    out = np.zeros(a.shape[1])
    if not used.any():
        return out
    size = size[used]
    u, s, vt = np.linalg.svd(a[:, used] / size, full_matrices=False)
    keep = s > rounding * s[0]
    solution = vt[keep].T @ ((u[:, keep].T @ b) / s[keep]) / size
    if not keep.all():
        # Any solution plus the null space; the one with the least norm is orthogonal to it.
        basis, _ = np.linalg.qr((vt[~keep] / size).T)
        solution = solution - basis @ (basis.T @ solution)
    out[used] = solution
    return out


def solve_factor(factor: Factor, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Intercept and coefficients that minimise SSE + alpha * ||coefficients||^2."""
    if alpha < 0:
        raise ValueError("alpha must not be negative.")
    a, b = factor.centred
    d = len(factor.features)
    if d == 0:
        coef = np.zeros(0)
    elif alpha == 0:
        coef = min_norm(a, b, np.sqrt((factor.r[:, 1:d + 1] ** 2).sum(axis=0)))
    else:
        q, r = np.linalg.qr(np.concatenate((a, np.sqrt(alpha) * np.eye(d))))
        coef = np.linalg.solve(r, q.T @ np.concatenate((b, np.zeros(d))))
    mean = factor.means
    return float(mean[d] - mean[:d] @ coef), coef
