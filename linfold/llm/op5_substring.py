"""Substring duplicate removal by level-wise doubling.

Removes each word covered by a window of ``size`` (20) consecutive words that also starts earlier:
in a text with a smaller doc_id, or earlier in the same text. Windows are judged on the input.

Three levels, each a pass over the whole corpus that only survivors of the one before enter:

5 words   of the 5-word windows in a 20-word window the one with the smallest hash stands for it.
          Equal 20-word windows have it in common, so those whose 5-word window occurs once go;
10 words  the others are extended to the 10-word window that starts with the 5-word one or, where
          that would not fit, ends with it. Those whose 10-word window occurs once go;
20 words  of equal 20-word windows the earliest stays, the others are marked.

Consecutive 20-word windows with the same 5-word and 10-word window are one row of the first two
passes. These are dealt by the window's hash and sorted, and a row survives if a neighbour has the
same hash: nothing is gathered. What a slice of texts holds twice or more survives by that alone,
and one row of it goes to the others' task, so a passage that very many texts share sends a row per
slice. The last pass meets the texts again: each slice marks its own repeats and sends the earliest
of each window, packed by ranges of the hash.

Windows are equal if their hashes are, 96 bits in the last pass; texts are not compared. Both hashes
are made of 64-bit hashes of the words, so windows that differ in one word alone agree with a chance of
2**-64 (where the two words have one hash), others with about 2**-96.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common
from linfold.llm.anchors import _merge_runs, marked_units, sliding_min
from linfold.llm.textbytes import BASE, CHUNK_BYTES, U64, Texts, chunks, mix, window_hash, windows

SIZE = 20
SLICE_BYTES = 768 << 10       # texts searched at a time
RANGE_WINDOWS = 200_000       # 20-word windows compared at a time
SHORT, HALF = 1, 2            # a row's 5-word (10-word) window occurs twice or more in its slice
HALF_ROW = "half long, known byte, k long, pos int, n int"
LEVEL_ROW = "short long, " + HALF_ROW
LOW = U64((1 << 32) - 1)
OTHER = 0xD6E8FEB86659FD93    # a second multiplier, so that the last 32 bits are independent of the rest


def pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed (column z), for the way through a shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in chunks(batches, max_bytes=4 * SLICE_BYTES):
        i = batch.schema.get_field_index("text")
        z = pa.array([press.compress(t.encode()) for t in batch.column(i).to_pylist()], pa.binary())
        yield batch.set_column(i, "z", z)


def unpressed(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The texts again, in slices of about ``max_bytes``."""
    unpack = zstandard.ZstdDecompressor()
    for part in chunks(batches, "z", max_bytes // 2):
        i = part.schema.get_field_index("z")
        text = pa.array([unpack.decompress(z) for z in part.column(i).to_pylist()], pa.binary())
        yield from chunks(iter([part.set_column(i, "text", text)]), max_bytes=max_bytes)


def _dealt(hashes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row of a slice is dealt to, and whether its hash occurs again in the slice: one row
    of each hash goes by the hash, others of the same hash by their place."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    more, known = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
    more[order[1:][same]] = True
    known[order[1:][same]] = True
    known[order[:-1][same]] = True
    return np.where(more, place, hashes), known


def candidates(size: int):
    """Rows of the first two levels: runs of windows at ``pos`` to ``pos + n`` of text ``k`` with the
    same window of a quarter and of half the size."""
    gram = size // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=SLICE_BYTES):
            t = Texts(part.column("text"))
            start, row = windows(t.first, size)
            if not len(start):
                continue
            value = t.word_hash()
            short, half = window_hash(value, gram), window_hash(value, 2 * gram)
            # The smallest by its upper 32 bits, the first of equal ones: a rule of the words alone.
            ranked = (short & ~LOW) | np.arange(len(short), dtype=U64)
            at = (sliding_min(ranked, size - gram + 1)[start] & LOW).astype(np.int64)
            ends = at - start > size - 2 * gram   # the longer window ends with the shorter one
            wide = np.where(ends, at - gram, at)
            new = np.ones(len(start), dtype=bool)
            new[1:] = (at[1:] != at[:-1]) | (wide[1:] != wide[:-1]) | (start[1:] != start[:-1] + 1)
            lead = np.flatnonzero(new)
            k, pos = part.column("_k").to_numpy()[row[lead]], (start - t.first[row])[lead]
            place = mix(k.astype(U64) * U64(BASE) + pos.astype(U64))
            # One place of the corpus can make a row of each kind, which must not meet.
            kind = ends[lead] * U64(OTHER)
            by_short, twice = _dealt(mix(short[at[lead]] ^ kind), place)
            by_half, again = _dealt(mix(half[wide[lead]] ^ kind), place)
            known = (SHORT * twice + HALF * again).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(by_short.view(np.int64)), pa.array(by_half.view(np.int64)), pa.array(known), pa.array(k),
                 pa.array(pos.astype(np.int32)), pa.array(np.diff(np.append(lead, len(start))).astype(np.int32))],
                ["short", "half", "known", "k", "pos", "n"])

    return run


def repeated(key: str, bit: int):
    """Of rows sorted by ``key`` those with a neighbour of the same key, and those known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None   # the last row, whose next one is not known yet
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = batch.column(key).to_numpy()
            keep = (batch.column("known").to_numpy() & bit) != 0
            same = keys[1:] == keys[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
            # The held row keeps what it has learned in ``known``.
            held = batch.slice(batch.num_rows - 1)
            if keep[-1]:
                i = held.schema.get_field_index("known")
                held = held.set_column(i, held.schema.field(i), pa.array(held.column(i).to_numpy() | bit, pa.int8()))
        if held is not None:
            yield held.filter(pa.array((held.column("known").to_numpy() & bit) != 0))

    return run


def _marks(k: np.ndarray, pos: np.ndarray, spread: bool) -> pa.RecordBatch:
    """Marked windows as runs; ``spread``: dealt by their place."""
    k, pos, n = _merge_runs(k, pos.astype(np.int64), np.ones(len(k), np.int64))
    columns = [pa.array(k), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))]
    if not spread:
        return pa.RecordBatch.from_arrays(columns, ["k", "pos", "n"])
    return pa.RecordBatch.from_arrays([pa.array((mix(k.astype(U64)) >> U64(1)).view(np.int64)), *columns,
                                       pa.nulls(len(k), pa.binary())], ["range", "k", "pos", "n", "data"])


FULL = np.dtype([("hash", "<u8"), ("check", "<u4"), ("pos", "<i4"), ("k", "<i8")])


def _later(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows and, in it, which have an equal one before them."""
    order = np.lexsort((w["pos"], w["k"], w["check"], w["hash"]))
    later = np.zeros(len(w), dtype=bool)
    later[1:] = (w["hash"][order][1:] == w["hash"][order][:-1]) & (w["check"][order][1:] == w["check"][order][:-1])
    return order, later


def packed_windows(size: int, ranges: int):
    """The last level within a slice of texts with their runs (``found``): marks, and the earliest of
    each window, packed field by field for each range of hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unpressed(batches, SLICE_BYTES):
            t = Texts(part.column("text"))
            lists = part.column("found")
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            pos, n = (lists.flatten().field(c).to_numpy().astype(np.int64) for c in ("pos", "n"))
            row, nth = np.repeat(row, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(pos, n) + nth
            value = t.word_hash()
            start = t.first[row] + at
            other = window_hash(value * U64(OTHER) + (value >> U64(29)), size)[start]
            w = np.empty(len(at), FULL)
            w["hash"], w["check"] = window_hash(value, size)[start], (other >> U64(32)).astype(np.uint32)
            w["pos"], w["k"] = at, part.column("_k").to_numpy()[row]
            order, later = _later(w)
            gone, w = w[order[later]], w[order[~later]]
            if len(gone):
                yield _marks(gone["k"], gone["pos"], True)
            of = (w["hash"] >> U64(32)) * U64(ranges) >> U64(32)
            order = np.lexsort((w["pos"], w["k"], of))
            w, of = w[order], of[order].astype(np.int64)
            edge = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of))
            data = [b"".join(w[b:e][c].tobytes() for c in FULL.names) for b, e in zip(edge[:-1], edge[1:], strict=True)]
            none = pa.array(np.zeros(len(data), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(of[edge[:-1]]), pa.array(np.zeros(len(data), np.int64)), none, none,
                                              pa.array(data, pa.binary())], ["range", "k", "pos", "n", "data"])

    return run


def _unpacked(data: bytes) -> np.ndarray:
    w, begin = np.empty(len(data) // FULL.itemsize, FULL), 0
    for c in FULL.names:
        w[c] = np.frombuffer(data, FULL[c], len(w), begin)
        begin += FULL[c].itemsize * len(w)
    return w


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last level over all slices, one range of hashes after the other (rows sorted by range)."""
    held: list[np.ndarray] = []
    current = None

    def finished() -> pa.RecordBatch:
        w = np.concatenate(held)
        order, later = _later(w)
        gone = w[order[later]]
        return _marks(gone["k"], gone["pos"], False)

    for batch in batches:
        marks = batch.filter(batch.column("data").is_null())
        yield marks.select(["k", "pos", "n"])
        rest = batch.filter(batch.column("data").is_valid())
        for of, data in zip(rest.column("range").to_pylist(), rest.column("data"), strict=True):
            if held and of != current:
                yield finished()
                held = []
            current = of
            held.append(_unpacked(data.as_py()))
    if held:
        yield finished()


def marked(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """_k, marks: for each text of ``rows`` (_k unique and ordered, text) with windows that also
    start earlier the list of (pos, n) of their runs."""
    spark = rows.sparkSession
    common.prepare(spark)
    least = common.shuffle_partitions(spark)
    found = rows.select("_k", "text").mapInArrow(candidates(size), LEVEL_ROW)
    found = (found.repartition(least, "short").sortWithinPartitions("short")
             .mapInArrow(repeated("short", SHORT), LEVEL_ROW).drop("short"))
    found = (found.repartition(least, "half").sortWithinPartitions("half")
             .mapInArrow(repeated("half", HALF), HALF_ROW).drop("half", "known"))
    found = common.saved(found, "substring-found")
    ranges = common.partitions_for(found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], RANGE_WINDOWS, least)
    listed = found.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct("pos", "n")).alias("found"))
    packed = (rows.select("_k", "text").mapInArrow(pressed, "_k long, z binary")
              .join(listed.hint("shuffle_hash"), "_k").select("_k", "z", "found")
              .mapInArrow(packed_windows(size, ranges), "range long, k long, pos int, n int, data binary"))
    marks = (packed.repartition(least, "range").sortWithinPartitions("range")
             .mapInArrow(settled, "k long, pos int, n int"))
    return marks.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct("pos", "n")).alias("marks"))


def removed(docs: DataFrame, size: int = SIZE, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs``; with ``texts`` also kept,
    the words left, joined by one space.

    Nulls: a null text has no words; rows with a null doc_id come after all others. Rows that share
    a doc_id are documents of their own, in the order of their texts; of equal rows one stays.
    Empty table: no rows. Other columns are ignored. Texts of any length are taken whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unpressed(batches, CHUNK_BYTES):
            t = Texts(part.column("text"))
            gone = marked_units(part.column("marks"), t.first[:-1], t.n_words, size)
            left = np.flatnonzero(~gone)
            # The kept words, each with one byte after it, which becomes a space.
            keep = np.zeros(len(t.buf) + 1, dtype=np.int8)
            np.add.at(keep, t.start[left], 1)
            np.add.at(keep, t.end[left] + 1, -1)
            flat = t.buf[np.cumsum(keep[:-1]) > 0]
            size_of = np.concatenate(([0], np.cumsum(t.end[left] - t.start[left] + 1)))
            flat[size_of[1:] - 1] = 32
            bound = size_of[np.searchsorted(left, t.first)]
            raw = flat.tobytes()
            kept = [raw[b:max(b, e - 1)] for b, e in zip(bound[:-1], bound[1:], strict=True)]
            total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
            out = [part.column("doc_id"), pa.array(t.n_words.astype(np.int64)),
                   pa.array(total[t.first[1:]] - total[t.first[:-1]]),
                   pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                out.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(out, names)

    if size < 4 or size % 4:
        raise ValueError("size must be a multiple of four words.")
    rows = common.keyed(docs)
    marks = marked(rows, size)
    return (rows.select("_k", "doc_id", "text").mapInArrow(pressed, "_k long, doc_id long, z binary")
            .join(marks.hint("shuffle_hash"), "_k", "left").select("doc_id", "z", "marks")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                             + ", kept string" * texts))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(common.table(spark, sf_dir, "documents"))
