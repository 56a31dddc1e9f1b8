"""Stochastic gradient descent baseline (B3): a step per row, or per mini-batch.

Row by row (``fit_sgd_rows``): rows are put in a seeded order of their key. A step on the row z =
[1, x], y is the affine map w -> (S - rate z z') w + rate y z, where S takes the penalty off; maps of
consecutive rows compose to one such map, (d + 1) (d + 2) numbers. Every task composes its range of
the order, ranges compose in a tree in their order, and an epoch is one application of the whole map.
So the data is read once, and the result is that of a loop over the rows, in any layout.

Inside a task, steps are composed ``STEP_ROWS`` at a time: with the residuals e, one forward
substitution (I + rate L) e = Z w - y, L the strict lower triangle of the rows' products, replaces
the loop, for any w at once.

By mini-batches (``fit_sgd``): rows are dealt to ``batches`` mini-batches by a seeded hash of their
key. One pass sums up the products of [1, x, y] per mini-batch; an epoch then takes one step per
mini-batch, in order, with the mini-batch's mean gradient (Zw - y) Z' plus alpha * w (the intercept
is not penalised). A task and the driver hold ``batches`` times (d + 2)^2 numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import hash52, quote
from linfold.operators.blocks import numeric_selection, valid_blocks
from linfold.operators.gd import TrainingResult, check_settings
from linfold.operators.gram import MERGE_WAYS, _arrow_sum, _check_rows, penalty_diagonal
from linfold.session import ship_package

_BATCH = "__batch"
STEP_ROWS = 16


def batch_products(df: DataFrame, features: list[str], target: str, batches: int, seed: int,
                   key: list[str] | None = None, algorithm: str = "md5") -> np.ndarray:
    """Sums of the outer products of [1, x, y] per mini-batch (batches x (d + 2) x (d + 2))."""
    if batches < 1:
        raise ValueError("batches must be at least 1.")
    k = len(features) + 2
    dealt = F.pmod(hash52(seed, *(key or [*features, target]), algorithm=algorithm), F.lit(batches))

    def add(block, total):
        out = total.reshape(batches, k, k)
        own = np.column_stack([np.ones(len(block)), block[:, :-1]])
        order = np.argsort(block[:, -1], kind="stable")
        ids, start = np.unique(block[order, -1].astype(int), return_index=True)
        for i, rows in zip(ids, np.split(order, start[1:])):
            out[i] += own[rows].T @ own[rows]

    v = _arrow_sum(df.withColumn(_BATCH, dealt), [*features, target, _BATCH], add, batches * k * k, adds=True)
    return v[1:].reshape(batches, k, k)


def fit_sgd(df: DataFrame, features: list[str], target: str, epochs: int = 1000,
            learning_rate: float = 0.01, alpha: float = 0.0, random_state: int = 42,
            batches: int = 32, key: list[str] | None = None) -> TrainingResult:
    """``epochs`` passes over the mini-batches from zero weights. ``key``: the columns whose hash
    deals a row to its mini-batch (default: features and target)."""
    check_settings(epochs, learning_rate, alpha)
    features = list(features)
    products = batch_products(df, features, target, batches, random_state, key)
    products = products[products[:, 0, 0] > 0]
    size = products[:, 0, 0][:, None]
    gram, moment = products[:, :-1, :-1] / size[:, :, None], products[:, :-1, -1] / size
    decay = penalty_diagonal(len(features) + 1, alpha)
    w = np.zeros(len(features) + 1)
    for _ in range(epochs):
        for g, r in zip(gram, moment):
            w = w - learning_rate * (g @ w - r + decay * w)
    return TrainingResult(w, [], epochs, tuple(features), not bool(np.all(np.isfinite(w))))


def step_map(z: np.ndarray, y: np.ndarray, rate: float, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(A, b): the steps on the rows ``z`` (ones first), ``y``, in order, take w to A w + b."""
    width = z.shape[1]
    a, b = np.eye(width), np.zeros(width)
    whole = len(z) // STEP_ROWS * STEP_ROWS
    for begin, end, size in ((0, whole, STEP_ROWS), (whole, len(z), len(z) - whole)):
        if begin == end:
            continue
        rows, target = z[begin:end].reshape(-1, size, width), y[begin:end].reshape(-1, size)
        shrink = 1.0 - rate * alpha
        step = np.arange(size)
        # What the penalty leaves of a weight after the steps between two rows of a group.
        between = np.tril(shrink ** np.maximum(step[:, None] - step[None, :] - 1, 0), -1)
        lower = rate * (np.tril(np.ones((size, size)), -1)
                        + (rows[:, :, 1:] @ rows[:, :, 1:].transpose(0, 2, 1)) * between)
        before, after = rows.copy(), rows.copy()
        before[:, :, 1:] *= (shrink ** step)[:, None]
        after[:, :, 1:] *= (shrink ** (size - 1 - step))[:, None]
        solved = np.linalg.solve(np.eye(size) + lower, np.concatenate((before, target[:, :, None]), axis=2))
        moved = rate * after.transpose(0, 2, 1) @ solved
        keep = np.diag(np.concatenate([[1.0], np.full(width - 1, shrink ** size)]))
        for m in moved:
            own = keep - m[:, :-1]
            a, b = own @ a, own @ b + m[:, -1]
    return a, b


def epoch_map(df: DataFrame, features: list[str], target: str, learning_rate: float, alpha: float, seed: int,
              key: list[str] | None = None, algorithm: str = "md5") -> tuple[np.ndarray, np.ndarray]:
    """(A, b) of one step on every row of ``df`` in the order of ``hash52(seed, key)`` (ties: of the
    row's values)."""
    spark = df.sparkSession
    ship_package(spark)
    columns, width = [*features, target], len(features) + 1
    parts = max(MERGE_WAYS, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    dealt = df.select(hash52(seed, *(key or columns), algorithm=algorithm).alias("place"),
                      *[F.col(quote(c)) for c in dict.fromkeys(columns)])
    order = ["place", *[F.col(quote(c)) for c in dict.fromkeys(columns)]]
    schema = "part int, n long, nulls long, odd long, a binary, b binary"

    def record(counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), *[pa.array([int(c)], pa.int64()) for c in counts],
             pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())],
            ["part", "n", "nulls", "odd", "a", "b"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, a, b = np.zeros(3, dtype=np.int64), np.eye(width), np.zeros(width)
        with np.errstate(over="ignore", invalid="ignore"):   # a diverging run shows in the weights
            for block in valid_blocks(batches, counts):
                own, moved = step_map(np.column_stack([np.ones(len(block)), block[:, :-1]]), block[:, -1],
                                      learning_rate, alpha)
                a, b = own @ a, own @ b + moved
        yield record(counts, a, b)

    def composed(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts, a, b = np.zeros(3, dtype=np.int64), np.eye(width), np.zeros(width)
        for row in rows:
            counts += row["n"], row["nulls"], row["odd"]
            own = np.frombuffer(row["a"]).reshape(width, width)
            with np.errstate(over="ignore", invalid="ignore"):
                a, b = own @ a, own @ b + np.frombuffer(row["b"])
        return counts, a, b

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield record(*composed(row for batch in batches for row in batch.to_pylist()))

    ranges = numeric_selection(dealt.repartitionByRange(parts, *order).sortWithinPartitions(*order), columns)
    maps = ranges.mapInArrow(local, schema)
    way = F.least(F.floor(F.col("part") * MERGE_WAYS / parts), F.lit(MERGE_WAYS - 1)).cast("int")
    maps = maps.repartitionById(MERGE_WAYS, way).sortWithinPartitions("part").mapInArrow(merged, schema)
    counts, a, b = composed(sorted((r.asDict() for r in maps.collect()), key=lambda r: r["part"]))   # MERGE_WAYS rows
    _check_rows(*[int(c) for c in counts])
    return a, b


def fit_sgd_rows(df: DataFrame, features: list[str], target: str, epochs: int = 1000, learning_rate: float = 0.01,
                 alpha: float = 0.0, random_state: int = 42, key: list[str] | None = None,
                 algorithm: str = "md5") -> TrainingResult:
    """``epochs`` passes over the rows from zero weights, a step per row with the gradient
    (w z - y) z plus alpha * w (the intercept is not penalised). ``key``: the columns whose seeded
    hash orders the rows (default: features and target)."""
    check_settings(epochs, learning_rate, alpha)
    features = list(features)
    a, b = epoch_map(df, features, target, learning_rate, alpha, random_state, key, algorithm)
    w = np.zeros(len(features) + 1)
    with np.errstate(over="ignore", invalid="ignore"):
        for _ in range(epochs):
            w = a @ w + b
    return TrainingResult(w, [], epochs, tuple(features), not bool(np.all(np.isfinite(w))))
