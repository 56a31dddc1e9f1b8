"""Suffix-array duplicate removal with a run-length index.

Removes each byte covered by a string of ``size`` (100) bytes that also starts earlier: in a text
with a smaller doc_id, or earlier in the same text. Matches never cross texts; overlaps count;
strings are judged on the input.

1. Each text is cut into segments by its anchors (see ``anchors``); a segment whose anchor occurs
   nowhere else in the corpus holds no repeat and goes. Rows are dealt by the anchor's hash and
   sorted, nothing is gathered; of the rows of one anchor in a slice of texts one goes to the others.
2. The bytes of the other segments are cut from the texts. Segments that share an anchor, a
   repetitive collection, are indexed by a run-compressed Burrows-Wheeler transform with samples at
   its run ends, and matching statistics are streamed over them (see ``rindex``): rows that match for
   ``size`` bytes or more are equal strings, of which the earliest stays and the others are marked.
   This is done first within a slice of texts, for anchors that it holds often, then by ranges of
   anchors over all that is left.
3. An anchor with more than ``HOT_ROWS`` segments after the first of these (the edges of a passage in
   very many texts) is dealt anew by the hashes of its single windows; windows whose hash occurs once
   go, the others come to the index as strings of ``size`` bytes.

Every marked string is a match in the index. Hashes deal the strings out and drop those that occur once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common
from linfold.llm.anchors import _merge_runs, byte_units, marked_units, segments
from linfold.llm.op5_substring import _dealt, pressed, repeated, unpressed
from linfold.llm.rindex import repeated_windows
from linfold.llm.textbytes import BASE, CHUNK_BYTES, U64, _Powers, chunks, mix, raw_bytes

SIZE, GRAM = 100, 24
SLICE_BYTES = 1 << 20     # texts searched at a time
INDEX_BYTES = 1 << 20     # strings indexed at a time
OFTEN = 8                 # segments of an anchor in a slice that are indexed there first
HOT_ROWS = 4096
FOUND = "key long, known byte, anchor long, k long, pos int, n int"
STRINGS = "key long, k long, pos int, n int, data binary"


@dataclass
class Strings:
    """Byte strings that hold the ``n`` windows from ``pos`` of text ``k`` on, with the key they are dealt by."""

    key: np.ndarray
    k: np.ndarray
    pos: np.ndarray
    n: np.ndarray
    data: list[bytes]

    def take(self, which: np.ndarray) -> Strings:
        return Strings(self.key[which], self.k[which], self.pos[which], self.n[which], [self.data[i] for i in which.tolist()])

    def cut(self, begin: int, end: int | None = None) -> Strings:
        of = slice(begin, end)
        return Strings(self.key[of], self.k[of], self.pos[of], self.n[of], self.data[of])

    def joined(self, other: Strings) -> Strings:
        return Strings(*(np.concatenate((getattr(self, c), getattr(other, c))) for c in ("key", "k", "pos", "n")),
                       self.data + other.data)

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.key), pa.array(self.k), pa.array(self.pos.astype(np.int32)), pa.array(self.n.astype(np.int32)),
             pa.array(self.data, pa.binary())], ["key", "k", "pos", "n", "data"])


def _found(hashes: np.ndarray, k: np.ndarray, pos: np.ndarray, n: np.ndarray, twice: np.ndarray | bool = False) -> pa.RecordBatch:
    """``twice``: rows that hold their anchor twice, so that they go on whatever the others are."""
    key, known = _dealt(hashes, mix(k.astype(U64) * U64(BASE) + pos.astype(U64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array((known | twice).astype(np.int8)), pa.array(hashes.view(np.int64)), pa.array(k),
         pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))], ["key", "known", "anchor", "k", "pos", "n"])


def candidates(size: int, gram: int):
    """Segments, dealt by their anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, max_bytes=SLICE_BYTES):
            units = byte_units(part.column("text"))
            row, at, n, anchor, twice = segments(units, size, gram)
            yield _found(anchor, part.column("_k").to_numpy()[row], at - units.first[row], n, twice)

    return run


def single_windows(size: int):
    """The windows of strings, dealt by their own hashes; ``n`` is a window's place in its string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "data", SLICE_BYTES // 4):
            units = byte_units(part.column("data"))
            k, pos, n = (part.column(c).to_numpy() for c in ("k", "pos", "n"))
            row = np.repeat(np.arange(len(k)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = units.first[row] + nth
            up, down = _Powers.get(len(units.value) + 1)
            prefix = np.concatenate((np.zeros(1, U64), np.cumsum(units.value * up[:len(units.value)])))
            batch = _found(mix((prefix[at + size] - prefix[at]) * down[at]), k[row], pos[row] + nth, nth)
            yield batch.set_column(4, "pos", pa.array(pos[row].astype(np.int32)))

    return run


def _runs(which: np.ndarray, nth: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, place and number of the ``some`` windows that follow one another in a string."""
    new = np.ones(len(some), dtype=bool)
    new[1:] = (which[some][1:] != which[some][:-1]) | (some[1:] != some[:-1] + 1)
    lead = np.flatnonzero(new)
    return which[some[lead]], nth[some[lead]], np.diff(np.append(lead, len(some)))


def settle(s: Strings, size: int) -> tuple[pa.RecordBatch, Strings]:
    """Marks, as rows without data, of the windows that the index finds earlier in ``s``; the others."""
    later = repeated_windows(s.data, s.k, s.pos, s.n, size)
    which = np.repeat(np.arange(len(s.k)), s.n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(s.n) - s.n, s.n)
    of, into, n = _runs(which, nth, np.flatnonzero(later))
    k, pos, n = _merge_runs(s.k[of], s.pos[of] + into, n)
    marks = pa.RecordBatch.from_arrays(
        [pa.array((mix(k.astype(U64)) >> U64(1)).view(np.int64)), pa.array(k), pa.array(pos.astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.nulls(len(k), pa.binary())], ["key", "k", "pos", "n", "data"])
    of, into, n = _runs(which, nth, np.flatnonzero(~later))
    data = [s.data[i][b:b + m + size - 1] for i, b, m in zip(of.tolist(), into.tolist(), n.tolist(), strict=True)]
    return marks, Strings(s.key[of], s.k[of], s.pos[of] + into, n, data)


def _whole_keys(s: Strings, last: bool) -> list[tuple[int, int]]:
    """Ranges of strings sorted by key: whole keys, about ``INDEX_BYTES`` each. Unless ``last``, the last
    key may go on and the last range must be full."""
    total = np.cumsum([0, *map(len, s.data)])
    ends = np.flatnonzero(s.key[1:] != s.key[:-1]) + 1
    if last:
        ends = np.append(ends, len(s.key))
    out, begin = [], 0
    while len(ends) and begin < ends[-1]:
        over = int(np.searchsorted(total[ends], total[begin] + INDEX_BYTES))
        if over >= len(ends) and not last:
            break
        out.append((begin, int(ends[min(over, len(ends) - 1)])))
        begin = out[-1][1]
    return out


def _sent(s: Strings, size: int, often: int) -> Iterator[pa.RecordBatch]:
    """The strings of a slice of texts. Keys with ``often`` strings or more are settled in it, and their
    earliest windows go on."""
    _, place, count = np.unique(s.key, return_inverse=True, return_counts=True)
    many = count[place] >= often
    yield s.take(np.flatnonzero(~many)).batch()
    s = s.take(np.flatnonzero(many)[np.argsort(s.key[many], kind="stable")])
    for b, e in _whole_keys(s, True):
        marks, left = settle(s.cut(b, e), size)
        yield marks
        yield left.batch()


def cut_strings(size: int, often: int = OFTEN):
    """Over texts with their lists of segments: the segments' bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unpressed(batches, SLICE_BYTES):
            data, bounds = raw_bytes(part.column("text"))
            lists = part.column("found")
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            anchor, pos, n = (lists.flatten().field(c).to_numpy() for c in ("anchor", "pos", "n"))
            pos, n = pos.astype(np.int64), n.astype(np.int64)
            at, raw = bounds[row] + pos, data.tobytes()
            cut = [raw[b:e] for b, e in zip(at.tolist(), (at + n + (size - 1)).tolist(), strict=True)]
            yield from _sent(Strings(anchor, part.column("_k").to_numpy()[row], pos, n, cut), size, often)

    return run


def cut_windows(size: int, often: int = OFTEN):
    """Over strings with their lists of windows: each window as a string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "data", SLICE_BYTES // 4):
            lists = part.column("found")
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            anchor, nth = (lists.flatten().field(c).to_numpy() for c in ("anchor", "n"))
            k, pos = (part.column(c).to_numpy().astype(np.int64)[row] for c in ("k", "pos"))
            data = part.column("data").to_pylist()
            cut = [data[i][b:b + size] for i, b in zip(row.tolist(), nth.tolist(), strict=True)]
            yield from _sent(Strings(anchor, k, pos + nth, np.ones(len(row), np.int64), cut), size, often)

    return run


def resolved(size: int):
    """Over rows sorted by key: all marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held, held_bytes, most = Strings(none, none, none, none, []), 0, 4 * INDEX_BYTES
        for batch in batches:
            yield batch.filter(batch.column("data").is_null()).select(["k", "pos", "n"])
            batch = batch.filter(batch.column("data").is_valid())
            key, k, pos, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("key", "k", "pos", "n"))
            new = batch.column("data").to_pylist()
            held = held.joined(Strings(key, k, pos, n, new))
            held_bytes += sum(map(len, new))
            if held_bytes <= INDEX_BYTES:
                continue
            ranges = _whole_keys(held, False)
            for b, e in ranges:
                yield settle(held.cut(b, e), size)[0].select(["k", "pos", "n"])
            if ranges:
                held = held.cut(ranges[-1][1])
            held_bytes = sum(map(len, held.data))
            if held_bytes > most:   # one key beyond what is indexed at a time: its earliest windows go on
                marks, held = settle(held, size)
                yield marks.select(["k", "pos", "n"])
                held = held.take(np.argsort(held.key, kind="stable"))
                held_bytes = sum(map(len, held.data))
                most = max(4 * INDEX_BYTES, 2 * held_bytes)
        for b, e in _whole_keys(held, True):
            yield settle(held.cut(b, e), size)[0].select(["k", "pos", "n"])

    return run


def _marks(rows: DataFrame, size: int, gram: int) -> DataFrame:
    """_k, marks: the runs of ``size``-byte strings of each text that also start earlier."""
    spark = rows.sparkSession
    common.prepare(spark)
    least = common.shuffle_partitions(spark)

    def again(found: DataFrame) -> DataFrame:
        """Rows whose key occurs again."""
        return found.repartition(least, "key").sortWithinPartitions("key").mapInArrow(repeated("key", 1), FOUND)

    found = (again(rows.select("_k", "text").mapInArrow(candidates(size, gram), FOUND)).groupBy(F.col("k").alias("_k"))
             .agg(F.collect_list(F.struct("anchor", "pos", "n")).alias("found")))
    strings = (rows.select("_k", "text").mapInArrow(pressed, "_k long, z binary").join(found.hint("shuffle_hash"), "_k")
               .select("_k", "z", "found").mapInArrow(cut_strings(size), STRINGS))
    strings = common.saved(strings, "suffix-strings", "zstd")
    hot = common.saved(strings.where("data is not null").groupBy("key").count().where(F.col("count") > HOT_ROWS)
                       .select("key"), "suffix-hot")
    if hot.limit(1).collect():
        whole = strings.where("data is not null").join(hot, "key", "left_semi").select("k", "pos", "n", "data")
        found = (again(whole.mapInArrow(single_windows(size), FOUND)).groupBy("k", "pos")
                 .agg(F.collect_list(F.struct("anchor", "n")).alias("found")))
        single = (whole.join(found.hint("shuffle_hash"), ["k", "pos"]).select("k", "pos", "data", "found")
                  .mapInArrow(cut_windows(size), STRINGS))
        strings = strings.join(hot, "key", "left_anti").select("key", "k", "pos", "n", "data").union(single)
    marks = strings.repartition(least, "key").sortWithinPartitions("key").mapInArrow(resolved(size), "k long, pos int, n int")
    return marks.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct("pos", "n")).alias("marks"))


def _removed(part: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, bounds = raw_bytes(part.column("text"))
    return data, bounds, marked_units(part.column("marks"), bounds[:-1], np.diff(bounds), size)


def removed(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``.

    Nulls: a null text is an empty one; rows with a null doc_id come after all others. Rows that
    share a doc_id are documents of their own, in the order of their texts; of equal rows one stays.
    Empty table: no rows. Other columns are ignored. Texts of any length are taken whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in unpressed(batches, CHUNK_BYTES):
            data, bounds, gone = _removed(part, size)
            total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
            starts = gone.copy()
            starts[1:] &= ~gone[:-1]
            inner = bounds[:-1][np.diff(bounds) > 0]
            starts[inner] = gone[inner]
            spans = np.concatenate(([0], np.cumsum(starts, dtype=np.int64)))
            digest = []
            for b, e in zip(bounds[:-1], bounds[1:], strict=True):
                own = data[b:e]
                digest.append(hashlib.sha256(own[~gone[b:e]] if total[e] > total[b] else own).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(total[bounds[1:]] - total[bounds[:-1]]),
                 pa.array(spans[bounds[1:]] - spans[bounds[:-1]]), pa.array(digest)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = common.keyed(docs)
    marks = _marks(rows, size, gram)
    return (rows.select("_k", "doc_id", "text").mapInArrow(pressed, "_k long, doc_id long, z binary")
            .join(marks.hint("shuffle_hash"), "_k", "left").select("doc_id", "z", "marks")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def keep(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """``docs`` (its columns) with every text without its repeated bytes, and n_chars, if there is
    one, counted anew. A code point of which only a part is repeated stays whole. A null text
    becomes an empty one. Texts of which nothing is left go; empty ones stay."""
    names = docs.columns
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("row")
    found = _marks(rows := common.keyed(docs, others), size, gram)
    row_type = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            data, bounds, gone = _removed(part, size)
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            if len(lead):
                whole = np.minimum.reduceat(gone.view(np.uint8), lead).astype(bool)
                gone = np.repeat(whole, np.diff(np.append(lead, len(data))))
            left = data[~gone].tobytes()
            end = np.concatenate(([0], np.cumsum(~gone, dtype=np.int64)))[bounds]
            text = [left[b:e].decode("utf-8", "replace") for b, e in zip(end[:-1], end[1:], strict=True)]
            out = pa.RecordBatch.from_arrays([part.column("row"), pa.array(text, pa.string())], ["row", "text"])
            yield out.filter(pa.array((np.diff(end) > 0) | (np.diff(bounds) == 0)))

    cut = (rows.join(found.hint("shuffle_hash"), "_k", "left").select("row", "text", "marks")
           .mapInArrow(run, f"row {row_type}, text string"))
    kinds = dict(docs.dtypes)

    def column(name: str):
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.char_length("text").cast(kinds[name]).alias(name)
        return F.col(f"row.`{name}`").alias(name)

    return cut.select(*[column(c) for c in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(common.table(spark, sf_dir, "documents"))
