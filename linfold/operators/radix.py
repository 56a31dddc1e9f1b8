"""Order statistics by radix selection: no value and no row crosses a shuffle.

A value's image is an unsigned 64-bit number of the same order. A pass counts, for every column and
every prefix of an image still of interest, the next ``DIGIT`` bits: one array of counts per task,
summed up block by block. The driver follows each wanted rank into one digit, and the next pass
looks only at the images with that prefix. The number of passes is fixed (``64 / DIGIT``, rounded
up), whatever the rows, the values or their ties; all columns and ranks share the passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.gram import BLOCK_SCHEMA, sum_blocks, vector_blocks
from linfold.session import ship_package

DIGIT = 11
TOP = np.uint64(1 << 63)
BITS = 64


def image(values: np.ndarray) -> np.ndarray:
    """Unsigned images in the order of the values (float64 without NaN, or int64)."""
    if values.dtype.kind == "i":
        return values.astype(np.int64).view(np.uint64) ^ TOP
    bits = (values + 0.0).view(np.uint64)   # + 0.0: one zero
    return np.where(bits & TOP, ~bits, bits | TOP)


def value_of(img: int, integer: bool):
    """The value behind an image."""
    bits = np.uint64(img)
    if integer:
        return int((bits ^ TOP).astype(np.int64))
    return float((bits ^ TOP if bits & TOP else ~bits).view(np.float64))


@dataclass(frozen=True)
class Found:
    """The value at a rank, the rows below it and the rows equal to it."""
    value: float | int
    less: int
    equal: int


def _images(column: pa.Array) -> np.ndarray:
    column = column.drop_null()
    values = column.to_numpy(zero_copy_only=False)
    if values.dtype.kind != "i":
        values = values.astype(float)
        values = values[~np.isnan(values)]
    return image(values)


def _histogram(frame: DataFrame, targets: list[tuple[int, int]], high: int, low: int) -> np.ndarray:
    """Per (column, prefix of the bits from ``high`` on) the counts of the bits ``low`` to ``high``."""
    size = 1 << (high - low)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((len(targets), size))
        for batch in batches:
            images = {c: _images(batch.column(c)) for c in {c for c, _ in targets}}
            for place, (c, prefix) in enumerate(targets):
                own = images[c]
                if high < BITS:
                    own = own[own >> np.uint64(high) == np.uint64(prefix)]
                digits = (own >> np.uint64(low)) & np.uint64(size - 1)
                acc[place] += np.bincount(digits.astype(np.int64), minlength=size)
        if acc.any():
            yield vector_blocks(acc.reshape(-1))

    return sum_blocks(frame.mapInArrow(run, BLOCK_SCHEMA), len(targets) * size).reshape(len(targets), size)


def select_ranks(df: DataFrame, columns: list[str], ranks: Callable[[int], list[int]],
                 integer: bool = False) -> list[dict[int, Found]]:
    """Per column the values at the 0-based ranks that ``ranks`` names for its number of values.
    NULL and NaN are no values; ranks beyond them are left out. ``integer``: columns hold integers."""
    ship_package(df.sparkSession)
    kind = "bigint" if integer else "double"
    frame = df.select(*[F.col(quote(c)).cast(kind).alias(f"c{i}") for i, c in enumerate(columns)])
    wanted: list[dict[int, list]] = []   # per column: rank -> [prefix, rows below, rows with the prefix]
    high = BITS
    while high > 0:
        low = max(high - DIGIT, 0)
        targets = ([(c, 0) for c in range(len(columns))] if high == BITS else
                   sorted({(c, state[0]) for c, of in enumerate(wanted) for state in of.values()}))
        if not targets:
            break
        counts = _histogram(frame, targets, high, low)
        if high == BITS:
            totals = counts.sum(axis=1).astype(np.int64)
            wanted = [{r: [0, 0, 0] for r in ranks(int(t)) if 0 <= r < t} for t in totals]
        place = {t: i for i, t in enumerate(targets)}
        for c, of in enumerate(wanted):
            for rank, state in of.items():
                row = counts[place[c, state[0]]]
                upto = state[1] + np.cumsum(row)
                digit = int(np.searchsorted(upto, rank, "right"))
                state[:] = [state[0] << (high - low) | digit, int(upto[digit] - row[digit]), int(row[digit])]
        high = low
    return [{rank: Found(value_of(s[0], integer), s[1], s[2]) for rank, s in of.items()} for of in wanted]


def quantiles(df: DataFrame, columns: list[str], q: float) -> list[float | None]:
    """The quantile ``q`` of each column, interpolated between the two nearest ranks (None: no values)."""
    totals: list[int] = []

    def ranks(total: int) -> list[int]:
        totals.append(total)
        place = (total - 1) * q
        return [int(np.floor(place)), int(np.ceil(place))] if total else []

    found = select_ranks(df, columns, ranks)
    out: list[float | None] = []
    for total, of in zip(totals, found, strict=True):
        if not total:
            out.append(None)
            continue
        place = (total - 1) * q
        a, b = of[int(np.floor(place))].value, of[int(np.ceil(place))].value
        out.append(a if a == b else a + (b - a) * (place - np.floor(place)))
    return out
