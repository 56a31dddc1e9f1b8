"""Rows of numbers as NumPy blocks: read from Arrow batches, or packed once for repeated passes.

``valid_blocks`` turns the batches of a numeric selection into float64 matrices and counts rows
with NULL and rows with NaN or infinite values, which never enter a block. ``PackedTable`` keeps a
table as rows of (n, nulls, odd, mark, dense block as bytes): later passes read the bytes as they
are, with no conversion, no NULL test and no finiteness test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.gram import _check_rows, _is_null, sum_blocks, usable_rows, vector_blocks
from linfold.session import ship_package

PACKED_BYTES = 4 << 20      # bytes of one packed block
PACKED_SCHEMA = "n long, nulls long, odd long, mark long, block binary"
MARK = np.uint64(0x9E3779B97F4A7C15)


def numeric_selection(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` as doubles, then a flag for rows that hold NULL in one of them."""
    return df.select(*[F.col(quote(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)],
                     _is_null(columns).cast("double").alias("is_null"))


def valid_blocks(batches: Iterator[pa.RecordBatch], counts: np.ndarray) -> Iterator[np.ndarray]:
    """The batches of a ``numeric_selection`` as matrices without the rows that hold NULL, NaN or
    infinite values; ``counts`` (rows, NULL rows, NaN or infinite rows) is added to."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        block = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                                 for i in range(batch.num_columns)])
        null, block = block[:, -1] > 0, block[:, :-1]
        odd = ~null & ~np.isfinite(block).all(axis=1)
        counts += len(block), null.sum(), odd.sum()
        keep = ~null & ~odd
        yield block if keep.all() else block[keep]


def row_marks(block: np.ndarray) -> int:
    """The sum of a hash of every row (64 bits): the same for any order and any cut of the rows."""
    bits = np.ascontiguousarray(block + 0.0).view(np.uint64)   # + 0.0: -0.0 and 0.0 are one value
    acc = np.full(len(block), MARK, dtype=np.uint64)
    for j in range(bits.shape[1]):
        acc = (acc ^ bits[:, j]) * MARK
        acc ^= acc >> np.uint64(29)
    return int(acc.sum(dtype=np.uint64))


class PackedTable:
    """Features and target of a table, packed once and kept until ``release``.

    ``invalid="error"`` rejects rows with NULL, NaN or infinite values when packing; ``"skip"``
    leaves them out. ``mark`` is the same for the same rows in any layout.
    """

    def __init__(self, df: DataFrame, features: list[str], target: str, invalid: str = "error"):
        ship_package(df.sparkSession)
        self.width = width = len(features) + 1
        rows = usable_rows(df, features, target, invalid)
        step = max(1, PACKED_BYTES // (8 * self.width))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, held, n = np.zeros(3, dtype=np.int64), [], 0

            def row(block: np.ndarray) -> pa.RecordBatch:
                mark = np.uint64(row_marks(block)).astype(np.int64)
                out = [[len(block)], [int(counts[1])], [int(counts[2])], [int(mark)], [block.tobytes()]]
                counts[:] = 0
                return pa.RecordBatch.from_arrays(
                    [*[pa.array(x, pa.int64()) for x in out[:4]], pa.array(out[4], pa.binary())],
                    ["n", "nulls", "odd", "mark", "block"])

            for block in valid_blocks(batches, counts):
                held.append(block)
                n += len(block)
                if n >= step:
                    yield row(np.concatenate(held))
                    held, n = [], 0
            if n or counts.any():
                yield row(np.concatenate(held) if held else np.zeros((0, width)))

        self.rows = (numeric_selection(rows, [*features, target]).mapInArrow(pack, PACKED_SCHEMA)
                     .persist(StorageLevel.MEMORY_AND_DISK))
        total = self.rows.agg(*[F.sum(c).alias(c) for c in ("n", "nulls", "odd")],
                              F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark")).first()
        self.n = total["n"] or 0
        self.mark = int(total["mark"] or 0) % (1 << 64)
        try:
            _check_rows(self.n + (total["nulls"] or 0) + (total["odd"] or 0), total["nulls"] or 0, total["odd"] or 0)
        except ValueError:
            self.release()
            raise

    def release(self) -> None:
        self.rows.unpersist()

    def sum(self, kernel, width: int) -> np.ndarray:
        """The sum of ``kernel(block)`` (``width`` numbers) over all blocks."""
        columns = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc, seen = np.zeros(width), False
            for batch in batches:
                for data in batch.column(0):
                    acc += kernel(np.frombuffer(data.as_buffer(), dtype=np.float64).reshape(-1, columns))
                    seen = True
            if seen:
                yield vector_blocks(acc)

        return sum_blocks(self.rows.select("block").mapInArrow(run, "blk int, vals array<double>"), width)
