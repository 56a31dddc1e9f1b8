"""Synthetic linear-regression data (S5), generated on the executors.

X ~ N(0, 1) (n x d), true weights ~ N(0, 1) of length d+1 (intercept first, drawn on the
driver: d+1 numbers), y = w0 + X w + N(0, noise); then the seeded split.

``method="hash"`` draws every number from ``md5(seed:column:id)`` (Box-Muller), so a row
is the same whatever the partitioning -- and DuckDB can recompute it. ``method="counter"`` draws
them from a keyed counter in Arrow batches: a 64-bit mix of (seed, id, column), two numbers per
Box-Muller pair, many times faster than md5 and as independent of the layout. ``method="randn"``
uses Spark's ``randn``, which is tied to the partition layout.
Row ids come from ``spark.range`` or from a key column of an existing table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import hash_normal, quote
from linfold.operators.split import train_test_split
from linfold.session import ship_package

# The increment and the multipliers of a public 64-bit counter generator (SplitMix64).
GOLDEN, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
U64 = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that look random, one to one."""
    x = (x ^ (x >> U64(30))) * U64(MIX1)
    x = (x ^ (x >> U64(27))) * U64(MIX2)
    return x ^ (x >> U64(31))


def counter_normals(ids: np.ndarray, columns: int, seed: int) -> np.ndarray:
    """Standard normal numbers (rows x columns) of the counters (seed, id, column)."""
    row = mixed(ids.astype(np.int64).view(U64) * U64(GOLDEN) + U64(seed % (1 << 64)))
    pairs = (columns + 1) // 2
    step = np.arange(1, 2 * pairs + 1, dtype=U64) * U64(GOLDEN)
    unit = ((mixed(row[:, None] + step[None, :]) >> U64(12)).astype(np.float64) + 0.5) / 2.0 ** 52
    radius, angle = np.sqrt(-2.0 * np.log(unit[:, 0::2])), 2.0 * np.pi * unit[:, 1::2]
    out = np.empty((len(ids), 2 * pairs))
    out[:, 0::2], out[:, 1::2] = radius * np.cos(angle), radius * np.sin(angle)
    return out[:, :columns]


def true_weights(n_features: int, random_state: int = 42) -> np.ndarray:
    return np.random.default_rng(random_state).normal(size=n_features + 1)


def synthetic_frame(spark: SparkSession, n_samples: int | None, n_features: int,
                    noise: float = 0.1, random_state: int = 42, method: str = "hash",
                    num_partitions: int | None = None, ids: DataFrame | None = None,
                    id_column: str = "id") -> tuple[DataFrame, np.ndarray]:
    if n_features < 1:
        raise ValueError("n_features must be at least 1.")
    if ids is None:
        if n_samples is None or n_samples < 2:
            raise ValueError("n_samples must be at least 2.")
        base = spark.range(0, n_samples, 1, num_partitions)
        id_column = "id"
    else:
        base = ids.select(F.col(quote(id_column)))
    w = true_weights(n_features, random_state)
    seed = int(random_state)
    if method == "hash":
        xs = [hash_normal(seed, F.lit(f"x{j + 1}"), F.col(quote(id_column)))
              for j in range(n_features)]
        eps = hash_normal(seed, F.lit("noise"), F.col(quote(id_column)))
    elif method == "counter":
        return _counter_frame(base, id_column, w, noise, seed), w
    elif method == "randn":
        xs = [F.randn(seed + j + 1) for j in range(n_features)]
        eps = F.randn(seed)
    else:
        raise ValueError("method must be 'hash', 'counter' or 'randn'.")
    frame = base.select(F.col(quote(id_column)),
                        *[x.alias(f"x{j + 1}") for j, x in enumerate(xs)],
                        (eps * F.lit(float(noise))).alias("_noise"))
    y = F.lit(float(w[0]))
    for j in range(n_features):
        y = y + F.lit(float(w[j + 1])) * F.col(f"x{j + 1}")
    frame = frame.select(F.col(quote(id_column)), *[f"x{j + 1}" for j in range(n_features)],
                         (y + F.col("_noise")).alias("y"))
    return frame, w


def _counter_frame(base: DataFrame, id_column: str, w: np.ndarray, noise: float, seed: int) -> DataFrame:
    ship_package(base.sparkSession)
    names = [f"x{j + 1}" for j in range(len(w) - 1)]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = counter_normals(batch.column(0).to_numpy(zero_copy_only=False), len(w), seed)
            y = np.full(len(z), w[0])
            for j in range(len(w) - 1):
                y = y + w[j + 1] * z[:, j]
            y = y + z[:, -1] * noise
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(z[:, j]) for j in range(len(w) - 1)], pa.array(y)],
                                             [id_column, *names, "y"])

    ids = base.select(F.col(quote(id_column)).cast("long").alias(id_column))
    schema = ", ".join([f"{quote(id_column)} long", *[f"{x} double" for x in [*names, "y"]]])
    return ids.mapInArrow(draw, schema)


def make_synthetic_regression(spark: SparkSession, n_samples: int, n_features: int,
                              noise: float = 0.1, random_state: int = 42,
                              test_size: float = 0.2, method: str = "hash",
                              num_partitions: int | None = None,
                              ids: DataFrame | None = None, id_column: str = "id",
                              split_hash: str = "md5", split_mode: str = "hash"):
    """Returns ``(train, test, true_weights)``; both frames hold ``id, x1..xd, y``. With
    ``split_mode="exact"`` test holds ``ceil(test_size * n_samples)`` rows."""
    frame, w = synthetic_frame(spark, n_samples, n_features, noise, random_state, method,
                               num_partitions, ids, id_column)
    key = "id" if ids is None else id_column
    train, test = train_test_split(frame, test_size, random_state, key=key, mode=split_mode,
                                   algorithm=split_hash)
    return train, test, w
