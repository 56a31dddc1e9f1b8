"""BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut into chunks where a rolling hash of the last ``REACH`` bytes hits a mask, so equal
passages are cut alike wherever they stand. Chunks that occur more than once in the corpus are
encoded once and their ids are sent to the texts that hold them; other chunks are encoded with
their text. A chunk's ids are right but for its ends, so each join is repaired: from a place before
the join where the pre-tokenizer always starts anew to one behind it, the text is encoded again, and
the range grows until the ids on both sides agree with its ends.

Steps: (1) hashes of all chunks are counted; (2) a bit table of fixed size holds the repeated hashes
and lets the second reading pass on only chunks that may be repeated, each once; (3) these are
encoded and join the lists of their texts; (4) texts and lists meet, texts compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import bpe, common
from linfold.llm.textbytes import BYTE_VALUE, CHUNK_BYTES, U64, _Powers, chunks, mix, raw_bytes

REACH, CHUNK_BITS = 32, 10         # chunks of 1 KiB on average
TABLE_BITS = 1 << 26               # 8 MiB, whatever the size of the corpus
WORD_BITS = 62


def chunk_bounds(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a batch of texts (``bounds``: n + 1 offsets), the texts' ends among
    them. No code point is cut."""
    total = len(data)
    ends = [bounds[1:]]
    if total >= REACH:
        up, down = _Powers.get(total + 1)
        prefix = np.concatenate((np.zeros(1, U64), np.cumsum(BYTE_VALUE[data] * up[:total])))
        rolling = mix((prefix[REACH:] - prefix[:-REACH]) * down[:total - REACH + 1])
        at = np.flatnonzero((rolling & U64((1 << CHUNK_BITS) - 1)) == 0) + REACH
        # The bytes looked at lie in one text, and the cut is before a first byte of a code point.
        start = bounds[np.searchsorted(bounds, at, "left") - 1]
        at = at[at - start >= REACH]
        at = at[at < total]
        ends.append(at[(data[at] & 0xC0) != 0x80])
    return np.unique(np.concatenate(ends))


def _chunk_lists(part: pa.RecordBatch) -> list[list[bytes]]:
    """The chunks of each text of a batch."""
    data, bounds = raw_bytes(part.column("text"))
    ends = chunk_bounds(data, bounds)
    raw = data.tobytes()
    out = []
    for b, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        cuts = [b, *ends[np.searchsorted(ends, b, "right"):np.searchsorted(ends, e, "right")].tolist()] if e > b else [b]
        out.append([raw[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)])
    return out


def chunk_key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        lists = _chunk_lists(part)
        keys = [chunk_key(c) for one in lists for c in one]
        sizes = [len(one) for one in lists]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(np.repeat(part.column("_k").to_numpy(), sizes)),
             pa.array([i for n in sizes for i in range(n)], pa.int32())], ["key", "k", "seq"])


def _place(key: bytes) -> tuple[int, int]:
    """Word and bit of a key in the bit table."""
    bit = int.from_bytes(key[:8], "little") % TABLE_BITS
    return bit // WORD_BITS, bit % WORD_BITS


def _table_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [_place(k) for k in batch.column("key").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in places], pa.int32()),
                                          pa.array([1 << b for _, b in places], pa.int64())], ["word", "bits"])


def _repeated_chunks(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        words = table.tolist()
        for part in chunks(batches):
            mine = {}
            for one in _chunk_lists(part):
                for c in one:
                    key = chunk_key(c)
                    word, bit = _place(key)
                    if words[word] >> bit & 1:
                        mine[key] = c
            yield pa.RecordBatch.from_arrays([pa.array(mine.keys(), pa.binary()),
                                              pa.array([press.compress(c) for c in mine.values()], pa.binary())],
                                             ["key", "z"])
    return run


def _small(ids: bytes) -> bytes:
    """Ids in 16 bits each where they fit (the first byte tells), compressed."""
    wide = np.frombuffer(ids, dtype="<u4")
    fits = not len(wide) or int(wide.max()) < 1 << 16
    return zstandard.ZstdCompressor(level=1).compress(b"\x02" + wide.astype("<u2").tobytes() if fits else b"\x04" + ids)


def _wide(small: bytes) -> bytes:
    raw = zstandard.ZstdDecompressor().decompress(small)
    return raw[1:] if raw[:1] == b"\x04" else np.frombuffer(raw[1:], dtype="<u2").astype("<u4").tobytes()


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder.get(path)
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            ids = [_small(encoder.encode(unpack.decompress(z).decode())) for z in batch.column("z").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], ["key", "ids"])
    return run


def last_start(text: str) -> int | None:
    """The last place where a space follows a character that is no white space: the pre-tokenizer
    starts anew there, whatever stands around."""
    at = text.rfind(" ")
    while at > 0:
        if not text[at - 1].isspace():
            return at
        at = text.rfind(" ", 0, at)
    return None


def first_start(text: str) -> int | None:
    at = text.find(" ", 1)
    while at > 0:
        if not text[at - 1].isspace():
            return at
        at = text.find(" ", at + 1)
    return None


def joined(parts: list[tuple[str, bytes]], encode, sizes: np.ndarray, restarts: bool = True) -> bytes:
    """Ids of the text that ``parts`` (text, ids) make up. ``sizes``: bytes of each token. With
    ``restarts`` false no place is known where the pre-tokenizer starts anew, and the text is
    encoded as one.

    Parts without a place of agreement wait, and are encoded once, together, when one is met: every
    byte is encoded twice at most, however long a text without spaces is."""
    if not restarts:
        return encode("".join(text for text, _ in parts))

    def cut(ids: bytes, n_bytes: int) -> int | None:
        """Offset in ``ids`` of the token that starts after ``n_bytes``, if one does."""
        total = np.cumsum(sizes[np.frombuffer(ids, dtype="<u4")])
        at = int(np.searchsorted(total, n_bytes))
        return 4 * (at + 1) if at < len(total) and total[at] == n_bytes else None

    out: list[bytes] = []
    waiting: list[str] = []             # text whose ids are not known; what follows it is ``text``
    text, ids = parts[0]
    for following, own in parts[1:]:
        if not waiting:
            i = last_start(text)
            left = cut(ids, len(text[:i].encode())) if i else None
            if left is not None:
                out.append(ids[:left])
            waiting = [text if left is None else text[i:]]
        j = first_start(following)
        right = cut(own, len(following[:j].encode())) if j else None
        if right is None:               # no agreement behind the join: the range grows to the right
            waiting.append(following)
        else:
            out.append(encode("".join(waiting) + following[:j]))
            waiting, text, ids = [], following[j:], own[right:]
    return b"".join(out) + (encode("".join(waiting)) if waiting else ids)


def coded(docs: DataFrame, path: str | None = None, values: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``; with ``values`` also
    ids (array) and decoded.

    Nulls: a null text is an empty one, without ids; a null doc_id stays null. Repeated rows and
    ties are coded one by one. Empty table: no rows. Other columns are ignored. Texts of any length
    are taken whole. A vocabulary file with another pre-tokenizer, a normalizer or merges out of the
    order of their ids is coded by the library alone, text by text.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    path = path or bpe.default_path()
    rows = common.keyed(docs)
    found = rows.select("_k", "text").mapInArrow(_keys, "key binary, k long, seq int")
    repeated = common.saved(found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "chunks")
    words = (repeated.mapInArrow(_table_words, "word int, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())   # TABLE_BITS bits at most
    table = np.zeros(TABLE_BITS // WORD_BITS + 1, dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    ids = (rows.select("text").mapInArrow(_repeated_chunks(table), "key binary, z binary")
           .join(repeated, "key", "left_semi").dropDuplicates(["key"])
           .mapInArrow(_encoded(path), "key binary, ids binary"))
    lists = (found.join(ids, "key").groupBy(F.col("k").alias("_k"))
             .agg(F.collect_list(F.struct("seq", "ids")).alias("known")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for part in chunks(batches):
            z = [press.compress(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("_k"), part.column("doc_id"), pa.array(z, pa.binary())],
                                             ["_k", "doc_id", "z"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder.get(path)
        sizes = encoder.sizes()
        unpack = zstandard.ZstdDecompressor()
        for part in chunks(batches, "z", CHUNK_BYTES // 4):   # about CHUNK_BYTES of text
            text = pa.array([unpack.decompress(z) for z in part.column("z").to_pylist()], pa.binary())
            cut = _chunk_lists(pa.RecordBatch.from_arrays([text], ["text"]))
            result = []
            for one, known in zip(cut, part.column("known").to_pylist(), strict=True):
                have = {x["seq"]: x["ids"] for x in known or ()}
                parts = [(c.decode(), _wide(have[i]) if i in have else encoder.encode(c.decode()))
                         for i, c in enumerate(one)]
                result.append(joined(parts, encoder.encode, sizes, encoder.known) if parts else b"")
            plain = [encoder.decode(x) for x in result]
            out = [part.column("doc_id"), pa.array([len(x) // 4 for x in result], pa.int64()),
                   pa.array([hashlib.sha256(x).hexdigest() for x in result]),
                   pa.array([hashlib.sha256(x.encode()).hexdigest() for x in plain])]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if values:
                out += [pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) for x in result], pa.list_(pa.int32())),
                        pa.array(plain, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(out, names)

    packed = rows.mapInArrow(pack, "_k long, doc_id long, z binary")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return (packed.join(lists.hint("shuffle_hash"), "_k", "left").select("doc_id", "z", "known")
            .mapInArrow(run, schema + ", ids array<int>, decoded string" * values))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(common.table(spark, sf_dir, "documents"))
