"""Document fingerprints: one-permutation MinHash with optimal densification, b bits a bin.

The shingles (``SHINGLE_WORDS`` words) of a text are hashed once. The top bits of a hash name one of
``BINS`` bins, and each bin keeps the smallest of the remaining bits. An empty bin takes the value of
the first filled bin in an order of its own, fixed and random, so that every filled bin is as likely
(optimal densification). Of each value, mixed with its bin, the low ``BITS`` bits are kept, packed into a hex string.
Likeness is the share of equal bins, corrected for the 2**-BITS that agree by chance.

Texts with fewer words have one shingle, all their words; a text without words has a fixed
fingerprint.
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
from linfold.llm.textbytes import CHUNK_BYTES, U64, Texts, chunks, mix, shingle_hash

SHINGLE_WORDS, BINS, BITS, SEED = 5, 512, 4, 1
BIN_SHIFT = U64(64 - BINS.bit_length() + 1)
EMPTY = np.iinfo(np.uint64).max
PROBES = 16        # probes of all texts at once; the few bins still empty then are filled text by text

_order: list[np.ndarray] = []


def _probe_order() -> tuple[np.ndarray, np.ndarray]:
    """For each bin, the order in which it looks at the others, and their ranks in it."""
    if not _order:
        order = np.argsort(np.random.default_rng(SEED).random((BINS, BINS)), axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.broadcast_to(np.arange(BINS), (BINS, BINS)), axis=1)
        _order.extend((order, rank))
    return _order[0], _order[1]


def densified(bins: np.ndarray) -> np.ndarray:
    """Bins (one row a text) with the empty ones filled; a row without any value gets zeros."""
    order, rank = _probe_order()
    out = bins.copy()
    filled = bins != EMPTY
    out[~filled.any(axis=1)] = 0
    row, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for probe in range(PROBES):
        if not len(row):
            return out
        other = order[empty, probe]
        hit = filled[row, other]
        out[row[hit], empty[hit]] = bins[row[hit], other[hit]]
        row, empty = row[~hit], empty[~hit]
    edge = np.flatnonzero(np.diff(row, prepend=-1, append=-1)) if len(row) else row
    for b, e in zip(edge[:-1], edge[1:], strict=True):
        have = np.flatnonzero(filled[row[b]])
        best = have[np.argmin(rank[empty[b:e]][:, have], axis=1)]
        out[row[b], empty[b:e]] = bins[row[b], best]
    return out


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The low bits of every bin (uint8), one row a text."""
    t = Texts(texts)
    values, row = shingle_hash(t.word_hash(), t.first, SHINGLE_WORDS)
    bins = np.full(t.n * BINS, EMPTY, dtype=U64)
    place = row * BINS + (values >> BIN_SHIFT).astype(np.int64)
    np.minimum.at(bins, place, values & ((U64(1) << BIN_SHIFT) - U64(1)))
    # Mixed with the bin, so that a value copied to many bins does not agree by chance in all of them.
    mixed = mix(densified(bins.reshape(t.n, BINS)) ^ mix(np.arange(BINS, dtype=U64)))
    return (mixed & U64((1 << BITS) - 1)).astype(np.uint8)


def packed(bits: np.ndarray) -> list[str]:
    """Hex strings, a digit a bin."""
    return [row.tobytes().hex() for row in (bits[:, 0::2] << 4) | bits[:, 1::2]]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles of each pair of rows, 0 to 1."""
    chance = 2.0 ** -BITS
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the beginning of ``following``."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _dealt(heads: dict[int, int], bounds: np.ndarray):
    """Rows dealt to parts by falling doc_id, texts compressed; the first row of each part also goes
    to the part before it, as its end (edge)."""
    last, places = len(bounds), sorted(heads)
    before = dict(zip(places, [places[-1], *places], strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches):
            ids = batch.column("doc_id").to_numpy()
            part = last - np.searchsorted(bounds, ids, "right")
            z = [press.compress(x.encode()) for x in batch.column("text").to_pylist()]
            first = np.array([heads[p] == i for p, i in zip(part.tolist(), ids.tolist(), strict=True)], dtype=bool)
            edge = np.flatnonzero(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((part, [before[p] for p in part[edge].tolist()])).astype(np.int32)),
                 pa.array(np.concatenate((np.zeros(len(ids), bool), np.ones(len(edge), bool)))),
                 pa.array(np.concatenate((ids, ids[edge]))),
                 pa.array(z + [z[i] for i in edge], pa.binary())], ["part", "edge", "doc_id", "z"])

    return run


OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
OUT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def _rows(ids: list, texts: list[str], following: list[str | None]) -> pa.RecordBatch:
    """Result rows; ``texts`` may have one more than ``ids``, the next of the last row."""
    n = len(ids)
    alone = [f is None for f in following]
    other = [edited(t, f or "") for t, f in zip(texts[:n], following, strict=True)]
    own, changed = fingerprints(pa.array(texts, pa.large_string())), fingerprints(pa.array(other, pa.large_string()))
    near_next = likeness(own[:n], np.concatenate((own[1:], own[:1]))[:n])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in other]), pa.array(packed(own[:n])),
         pa.array(packed(changed)), pa.array(likeness(own[:n], changed)), pa.array(near_next, mask=np.array(alone))], OUT)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, edge, falling doc_id, z): each row's next is the row after it in its
    part, the last row's the part's first edge row."""
    unpack = zstandard.ZstdDecompressor()
    part_now, ids, texts, size = None, [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        # All but the last text have their next.
        nonlocal ids, texts, size
        n = len(texts) - 1
        if n > 0:
            yield _rows(ids[:n], texts, texts[1:])
        ids, texts, size = ids[n:], texts[n:], 0

    closed = False
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "edge", "doc_id", "z")]
        for part, edge, doc, z in zip(*columns, strict=True):
            if part != part_now:
                if not closed:
                    yield from flush()
                part_now, ids, texts, size, closed = part, [], [], 0, False
            if closed:
                continue   # further rows with the doc_id of the next part's first
            text = unpack.decompress(z).decode()
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if edge:
                yield from flush()
                closed = True
            elif size > CHUNK_BYTES:
                yield from flush()


def _without_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        texts = part.column("text").to_pylist()
        yield _rows(part.column("doc_id").to_pylist(), texts, [None] * len(texts))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of
    every row of ``docs``. The next document is the one with the next smaller doc_id, the last
    one's is the first.

    Rows are dealt to parts by ranges of doc_id, so that texts are shuffled once; parts are sorted
    and read in order. Nulls: a null text is an empty one; a row without doc_id has no next
    document (its last third is cut off, near_next is null). Rows with the same doc_id follow one
    another in a fixed order of their contents. One row alone is its own next. Empty table: no
    rows. Other columns are ignored. Texts of any length are taken whole.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    base = common.documents(docs)
    ids = base.where("doc_id IS NOT NULL").select("doc_id")
    parts = 3 * common.shuffle_partitions(spark)
    cut = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    bounds = np.unique(np.array(cut or [], dtype=np.int64))   # one number a part

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("doc_id").to_numpy()
            part = len(bounds) - np.searchsorted(bounds, own, "right")
            for p in np.unique(part):
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([own[part == p].max()])],
                                                 ["part", "head"])

    heads = {r.part: r.head for r in ids.mapInArrow(place, "part int, head long")
             .groupBy("part").agg(F.max("head").alias("head")).collect()}   # one row a part
    none = base.where("doc_id IS NULL").mapInArrow(_without_id, OUT_SCHEMA)
    if not heads:
        return none
    dealt = (base.where("doc_id IS NOT NULL")
             .mapInArrow(_dealt(heads, bounds), "part int, edge boolean, doc_id long, z binary")
             .repartition(common.shuffle_partitions(spark), "part")
             .sortWithinPartitions("part", "edge", F.col("doc_id").desc(), "z"))
    return dealt.mapInArrow(_in_order, OUT_SCHEMA).union(none)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(common.table(spark, sf_dir, "documents"))
