"""Vectorised words, hashes and shingles over batches of UTF-8 texts (numpy, inside tasks).

A batch of texts becomes one byte array in which every text is followed by a newline. Words are
maximal runs of bytes other than space and 0x09-0x0D, so no word crosses a text. All hashes wrap
modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 512 << 10

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


class _Powers:
    """BASE**i and BASE**-i, grown to the longest chunk seen in this worker."""

    up = np.ones(1, dtype=U64)
    down = np.ones(1, dtype=U64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, CHUNK_BYTES + CHUNK_BYTES // 4)
            grown = []
            for base in (BASE, BASE_INV):
                x = np.full(n, base, dtype=U64)
                x[0] = 1
                grown.append(np.multiply.accumulate(x))
            cls.up, cls.down = grown
        return cls.up, cls.down


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``max_bytes`` of text each (one text at least, whole
    texts only); empty batches are passed over."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(text), 0)).astype(np.int64)
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


def raw_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes back to back and their offsets (n + 1); a null is an empty text."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    if not (pa.types.is_binary(text.type) or pa.types.is_large_binary(text.type)):
        text = text.cast(pa.large_string()).cast(pa.large_binary())
    else:
        text = text.cast(pa.large_binary())
    if text.null_count:
        text = text.fill_null(b"")
    if len(text) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0]:bounds[-1]], bounds - bounds[0]


class Texts:
    """Byte array of a batch of texts with its words.

    ``buf`` bytes with a newline after each text; ``row_start``/``row_end`` the texts' places;
    ``start``/``end`` the words' places; ``first`` (n + 1) the index of each text's first word.
    """

    def __init__(self, text: pa.Array, lower: bool = False):
        flat, bounds = raw_bytes(text)
        n = len(bounds) - 1
        self.n = n
        self.buf = np.full(len(flat) + n, 10, dtype=np.uint8)
        keep = np.ones(len(self.buf), dtype=bool)
        self.row_start = bounds[:-1] + np.arange(n)
        self.row_end = bounds[1:] + np.arange(n)
        keep[self.row_end] = False
        self.buf[keep] = flat
        if lower:
            self.buf[(self.buf >= 65) & (self.buf <= 90)] |= 32
        word = ~WHITE[self.buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
        self.is_word = word
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.append(np.searchsorted(self.start, self.row_start), len(self.start))
        self.n_words = np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def prefix(self) -> np.ndarray:
        """Prefix sums of the bytes' values times BASE**position (n + 1)."""
        up, _ = _Powers.get(len(self.buf) + 1)
        out = np.empty(len(self.buf) + 1, dtype=U64)
        out[0] = 0
        values = BYTE_VALUE[self.buf]
        values *= up[:len(self.buf)]
        np.cumsum(values, out=out[1:])
        return out

    def span_hash(self, start: np.ndarray, end: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of the bytes of each span; equal bytes have equal hashes."""
        prefix = self.prefix() if prefix is None else prefix
        _, down = _Powers.get(len(self.buf) + 1)
        return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))

    def word_hash(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)


def window_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive values (those that cross texts included)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = values[:n].copy()
    for j in range(1, size):
        out *= U64(BASE)
        out += values[j:j + n]
    return mix(out)


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the windows of ``size`` words that lie in one text, and their texts."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    begin = np.concatenate(([0], np.cumsum(counts)))
    index = np.arange(begin[-1]) - np.repeat(begin[:-1], counts) + np.repeat(first[:-1], counts)
    return index, row


def shingle_hash(word_hash: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each shingle of ``size`` words, in text order. A text with fewer words
    has one shingle, all its words; a text without words has none."""
    index, row = windows(first, size)
    values = window_hash(word_hash, size)[index] if len(index) else np.zeros(0, dtype=U64)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        acc = np.full(len(short), 0x5851F42D4C957F2D, dtype=U64)
        for j in range(size - 1):
            has = counts[short] > j
            acc[has] = acc[has] * U64(BASE) + word_hash[first[:-1][short][has] + j]
        values = np.concatenate((values, mix(acc)))
        row = np.concatenate((row, short))
        order = np.argsort(row, kind="stable")
        values, row = values[order], row[order]
    return values, row


def repeated_in_row(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values with their texts (ascending): which occur twice or more in their text, and
    which have an equal one earlier in it."""
    key = mix(values + row.astype(U64) * U64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def covered(index: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words the windows of ``size`` words at ``index`` cover."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, index, 1)
    np.add.at(delta, index + size, -1)
    return np.cumsum(delta[:-1]) > 0
