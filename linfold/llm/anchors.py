"""Anchors: places of byte strings that do not depend on the text around them.

A window is ``size`` consecutive bytes of one text. Of the ``gram``-byte grams in a window the one
with the smallest hash is its anchor, so equal windows have equal anchors. Consecutive windows whose
anchors have the same hash make a segment (of ``4 * size`` windows at most; longer ones, in texts of
one repeated phrase, are cut). A window can occur twice only if its anchor does: in two segments, or
at two places of one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from linfold.llm.textbytes import BYTE_VALUE, U64, _Powers, mix, raw_bytes


LOW = U64((1 << 32) - 1)


@dataclass
class Units:
    """The bytes of a batch of texts, a 64-bit value for each, and ``first`` (n + 1), each text's first."""

    value: np.ndarray
    first: np.ndarray
    data: np.ndarray


def byte_units(texts: pa.Array) -> Units:
    data, bounds = raw_bytes(texts)
    return Units(BYTE_VALUE[data], bounds, data)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values (of two ranges of a power of two that cover them)."""
    out = len(values) - width + 1
    if out <= 0:
        return values[:0]
    low, have = values, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:out], low[width - have:width - have + out])


def segments(units: Units, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, place (in the batch), number of windows and anchor hash of each segment of a batch, and
    whether its windows have their anchors at more than one place."""
    value, first = units.value, units.first
    total = len(value)
    counts = np.maximum(np.diff(first) - size + 1, 0)
    if not counts.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(U64), none.astype(bool)
    up, down = _Powers.get(total + 1)
    prefix = np.empty(total + 1, dtype=U64)
    prefix[0] = 0
    np.cumsum(value * up[:total], out=prefix[1:])
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[:total - gram + 1])
    # The smallest by its upper 32 bits, the first of equal ones: a rule of the bytes alone.
    ranked = (grams & ~LOW) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_min(ranked, size - gram + 1) & LOW).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    place = anchor[start]
    at_anchor = grams[place]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (at_anchor[1:] != at_anchor[:-1]) | (start[1:] != start[:-1] + 1) | (row[1:] != row[:-1])
    lead = np.flatnonzero(new)
    if np.diff(np.append(lead, len(start))).max() > 4 * size:
        nth = np.arange(len(start))
        new |= (nth - np.maximum.accumulate(np.where(new, nth, 0))) % (4 * size) == 0
        lead = np.flatnonzero(new)
    moved = np.zeros(len(start), dtype=bool)
    moved[1:] = (place[1:] != place[:-1]) & ~new[1:]
    return row[lead], start[lead], np.diff(np.append(lead, len(start))), at_anchor[lead], np.logical_or.reduceat(moved, lead)


def _merge_runs(k: np.ndarray, pos: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that follow one another in a text made one (sorted by k, pos)."""
    order = np.lexsort((pos, k))
    k, pos, n = k[order], pos[order], n[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (pos[1:] != pos[:-1] + n[:-1])
    lead = np.flatnonzero(new)
    return k[lead], pos[lead], np.add.reduceat(n, lead) if len(lead) else n


def marked_units(marks: pa.Array, row_first: np.ndarray, row_units: np.ndarray, size: int) -> np.ndarray:
    """Which units the marked windows cover. ``marks``: the batch's lists (null: none)."""
    total = int(row_first[-1] + row_units[-1]) if len(row_first) else 0
    delta = np.zeros(total + 1, dtype=np.int64)
    if marks.null_count:
        marks = marks.fill_null(pa.scalar([], marks.type))
    offsets = marks.offsets.to_numpy()
    row = np.repeat(np.arange(len(marks)), np.diff(offsets))
    flat = marks.flatten()
    if len(flat):
        at = row_first[row] + flat.field("pos").to_numpy()
        np.add.at(delta, at, 1)
        np.add.at(delta, at + flat.field("n").to_numpy() + (size - 1), -1)
    return np.cumsum(delta[:-1]) > 0
