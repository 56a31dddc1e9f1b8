"""Reproducible train/test split (P3) and chunking (P5).

``mode="hash"``: a row is in test when the first 52 bits of ``md5('<seed>:<key>')`` fall
below ``test_size * 2^52``. One narrow filter, no shuffle, no count; the membership of a
row never depends on partitioning, and DuckDB computes the same set.

``mode="exact"``: test holds exactly ``ceil(test_size * n)`` rows -- the ones with the
smallest hash (as the reference's permutation split has an exact size). The threshold
hash is found by radix selection (``radix.py``: counts cross the shuffle, no hash does); rows that
share the threshold hash (duplicate keys) are split by a row id, again by radix selection.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import TWO_POW_52, hash52, quote
from linfold.operators.select import kth_smallest, kth_smallest_with_counts
from linfold.session import materialize

_H = "__split_hash"
_RID = "__split_rowid"


def _key_columns(df: DataFrame, key: str | list[str] | None) -> list[str]:
    if key is None:
        return list(df.columns)
    keys = [key] if isinstance(key, str) else list(key)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Split key column(s) not found: {', '.join(missing)}")
    return keys


def _test_count(n: int, test_size: float | int) -> int:
    if isinstance(test_size, int) and not isinstance(test_size, bool):
        n_test = test_size
    else:
        if not 0.0 < float(test_size) < 1.0:
            raise ValueError("test_size must be a fraction in (0, 1) or a row count.")
        n_test = math.ceil(float(test_size) * n)
    if n_test <= 0 or n_test >= n:
        raise ValueError(f"With n_samples={n} and test_size={test_size} one split would be empty.")
    return n_test


def hash_test_flag(seed: int, keys: list[str], test_size: float,
                   algorithm: str = "md5") -> Column:
    """True for rows of the hash-mode test set."""
    if not 0.0 < float(test_size) < 1.0:
        raise ValueError("test_size must be a fraction in (0, 1) in hash mode.")
    return (hash52(seed, *keys, algorithm=algorithm).cast("double")
            < F.lit(float(test_size) * TWO_POW_52))


def split_flag(df: DataFrame, test_size: float | int = 0.2, seed: int = 42,
               key: str | list[str] | None = None, mode: str = "hash",
               column: str = "split", algorithm: str = "md5") -> DataFrame:
    """``df`` plus a string column ``split`` with values ``'train'`` / ``'test'``."""
    keys = _key_columns(df, key)
    if mode == "hash":
        flag = hash_test_flag(seed, keys, test_size, algorithm)
        return df.withColumn(column, F.when(flag, "test").otherwise("train"))
    if mode != "exact":
        raise ValueError("mode must be 'hash' or 'exact'.")
    base = df.withColumn(_H, hash52(seed, *keys, algorithm=algorithm))
    n_test = _test_count(df.count(), test_size)
    hashes = base.select(_H).persist(StorageLevel.MEMORY_AND_DISK)   # read by every pass of the selection
    try:
        threshold, less, equal = kth_smallest_with_counts(hashes, _H, n_test - 1)
    finally:
        hashes.unpersist()
    need = n_test - less
    if need == equal:
        flag = F.col(_H) <= F.lit(threshold)
        out = base
    else:
        # rows sharing the threshold hash: take `need` of them by a row id (exact selection);
        # checkpointed, so that the selection and every later read of the splits see the same ids
        out = materialize(base.withColumn(_RID, F.monotonically_increasing_id()), "checkpoint")
        ties = out.filter(F.col(_H) == F.lit(threshold))
        cut = kth_smallest(ties, _RID, need - 1)
        flag = (F.col(_H) < F.lit(threshold)) | (
            (F.col(_H) == F.lit(threshold)) & (F.col(_RID) <= F.lit(cut)))
    return out.withColumn(column, F.when(flag, "test").otherwise("train")).drop(_H, _RID)


def train_test_split(df: DataFrame, test_size: float | int = 0.2, seed: int = 42,
                     key: str | list[str] | None = None, mode: str = "hash",
                     algorithm: str = "md5") -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into ``(train, test)`` before any statistic is fitted."""
    if mode == "hash":
        flag = hash_test_flag(seed, _key_columns(df, key), test_size, algorithm)
        return df.filter(~flag), df.filter(flag)
    flagged = split_flag(df, test_size, seed, key, mode, column="__split", algorithm=algorithm)
    return (flagged.filter(F.col("__split") == "train").drop("__split"),
            flagged.filter(F.col("__split") == "test").drop("__split"))


def chunk_of(key: str | list[str], chunks: int, seed: int = 42, algorithm: str = "xxhash64") -> Column:
    """The chunk (0 .. chunks - 1) of a row as an expression of its key: a grouping key, so that
    chunks are formed without moving rows."""
    if chunks < 1:
        raise ValueError("chunks must be at least 1.")
    keys = [key] if isinstance(key, str) else list(key)
    return F.pmod(hash52(seed, *keys, algorithm=algorithm), F.lit(chunks)).cast("int")


__all__ = ["train_test_split", "split_flag", "hash_test_flag", "chunk_of", "quote"]
