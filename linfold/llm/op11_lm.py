"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark, stored as sorted
hash arrays and memory-mapped by the workers.

Tokens: A-Z lower-cased, words are runs of bytes other than space and 0x09-0x0D, then one end per
text. A token w after h (the beginning of a text counts as an h) has the probability
    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + gamma(h) * p(w)
    p(w)     = max(k(w) - E(k(w)), 0) / K + delta / (V + 1)
where c are counts, k(w) is the number of different h before w, K their sum, V the number of
different training tokens; D and E are the three modified Kneser-Ney discounts of counts 1, 2 and
3 or more, each from its own counts of counts (where these give none between 0 and the count, half
the count); gamma and delta give back what was taken off. After an h never seen p(w) is used. An
unknown token gets the share delta / (V + 1).

On Spark, three passes over the texts:
1. Bigrams are 64-bit hashes, counted per run of ``RUN_TOKENS`` tokens, shuffled by ranges of the
   hash (so no word is hot), summed, and written as one sorted array per range.
2. The arrays are memory-mapped. A bigram with count c that occurs n times in a run gives n / c to
   k(w) and to the number of bigrams of its count after h, so these sums over all runs are whole
   numbers, and no list of the words after an h is ever gathered. Word statistics, summed per run
   before the shuffle, are written as sorted arrays, too.
3. Texts look up their bigrams and words in the memory-mapped arrays.
Arrays lie in the folder of ``spark.checkpoint.dir``, which must be mounted at the workers. A hash
stands for its n-gram; two of 10**8 n-grams share one with a probability of 0.0003.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common
from linfold.llm.labels import fold
from linfold.llm.textbytes import BASE, CHUNK_BYTES, U64, WHITE, Texts, chunks, mix
from linfold.session import checkpoint_dir

RUN_TOKENS = 2_000_000          # tokens counted together in a task
SCORE_TOKENS = 500_000
START, END = U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)
HELD_MODULUS, HELD_VALUE = 5, 1
SMALL = 255                     # counts from here on are kept aside of the byte array


def bigram_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * U64(BASE) + word)


def _slices(batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES):
    """(texts, their rows, whether they begin, whether they end here): whole texts together, a text
    much longer than ``most`` bytes in slices cut after white space."""
    for piece in chunks(batches, max_bytes=most):
        text = piece.column("text")
        if piece.num_rows > 1 or text[0].as_buffer().size <= 2 * most:
            yield text, piece, True, True
            continue
        raw = np.frombuffer(text[0].as_buffer(), dtype=np.uint8)
        at = 0
        while at < len(raw):
            end = min(at + most, len(raw))
            if end < len(raw):
                white = np.flatnonzero(WHITE[raw[at:end]])
                if len(white):
                    end = at + int(white[-1]) + 1
                else:   # one word fills the slice: up to the next white space
                    while end < len(raw) and not WHITE[raw[end]]:
                        end += 1
            yield pa.array([raw[at:end].tobytes()], pa.large_binary()), piece, at == 0, end == len(raw)
            at = end


def tokens(batches: Iterator[pa.RecordBatch], most: int = CHUNK_BYTES):
    """(token before, token, row of ``piece``, piece, ends) of consecutive slices of texts."""
    carry = START
    for text, piece, begins, ends in _slices(batches, most):
        t = Texts(text, lower=True)
        words = t.word_hash()
        if begins:
            carry = START
        count = t.n_words + ends
        last = np.cumsum(count)
        if ends:
            out = np.empty(last[-1], dtype=U64)
            inner = np.ones(len(out), dtype=bool)
            inner[last - 1] = False
            out[inner], out[last - 1] = words, END
            words = out
        before = np.empty(len(words), dtype=U64)
        before[1:] = words[:-1]
        before[(last - count)[count > 0]] = carry
        if not ends and len(words):
            carry = words[-1]
        yield before, words, np.repeat(np.arange(t.n), count), piece, ends


def _runs(batches: Iterator[pa.RecordBatch], most: int):
    """(token before, token) arrays of about ``most`` tokens."""
    held, n = [], 0
    for before, word, *_ in tokens(batches):
        held.append((before, word))
        n += len(word)
        if n >= most:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def bounds(parts: int) -> np.ndarray:
    """Lower ends of ``parts`` equal ranges of hashes."""
    return np.array([(i << 64) // parts for i in range(parts)], dtype=U64)


def _dealt(keys: np.ndarray, columns: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """A row per range: sorted keys and packed columns."""
    press = zstandard.ZstdCompressor(level=1)
    edge = np.append(np.searchsorted(keys, bounds(parts)), len(keys))
    part = np.flatnonzero(np.diff(edge))
    spans = [slice(edge[p], edge[p + 1]) for p in part]
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array([keys[s].tobytes() for s in spans], pa.binary()),
         *[pa.array([press.compress(c[s].tobytes()) for s in spans], pa.binary()) for c in columns]],
        ["part", "keys", *[f"c{i}" for i in range(len(columns))]])


def _count_bigrams(parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for before, word in _runs(batches, RUN_TOKENS):
            keys, n = np.unique(bigram_key(before, word), return_counts=True)
            yield _dealt(keys, [n.astype(np.int64)], parts)
    return run


def _summed(keys: list[bytes], columns: list[list[bytes]], kinds: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Packed pieces of one range, with the columns summed per key."""
    unpack = zstandard.ZstdDecompressor()
    key = np.frombuffer(b"".join(keys), dtype=U64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    values = [np.frombuffer(b"".join(map(unpack.decompress, c)), dtype=k) for c, k in zip(columns, kinds, strict=True)]
    return key[first], [np.add.reduceat(v[order], first) for v in values]


def _by_part(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """(part, lists of each column) from rows sorted by part."""
    now, held = None, []
    for batch in batches:
        for part, *row in zip(*[batch.column(c).to_pylist() for c in ("part", *columns)], strict=True):
            if part != now:
                if held:
                    yield now, list(zip(*held, strict=True))
                now, held = part, []
            held.append(row)
    if held:
        yield now, list(zip(*held, strict=True))


def _write(folder: str, name: str, values: np.ndarray) -> None:
    """Written beside and renamed, so that a second attempt of a task finds or leaves a whole file."""
    beside = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with open(beside, "wb") as f:
        np.save(f, values)
    os.replace(beside, os.path.join(folder, f"{name}.npy"))


def _counts_of_counts(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in range(1, 5)] + [int((n > 2).sum())]


def _store_bigrams(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (keys, counts) in _by_part(batches, ["keys", "c0"]):
            key, (n,) = _summed(keys, [counts], [np.int64])
            big = np.flatnonzero(n >= SMALL)
            _write(folder, f"b{part}-key", key)
            _write(folder, f"b{part}-small", np.minimum(n, SMALL).astype(np.uint8))
            _write(folder, f"b{part}-big", np.stack((big, n[big])))
            yield pa.RecordBatch.from_pylist([{"part": part, "n": _counts_of_counts(n)}])
    return run


def _array(folder: str, name: str) -> np.ndarray:
    """A memory-mapped array; empty where its range holds nothing."""
    path = os.path.join(folder, f"{name}.npy")
    if not os.path.exists(path):
        return np.zeros(0, dtype=U64)
    with open(path, "rb") as f:
        np.lib.format.read_magic(f)
        shape, _, kind = np.lib.format.read_array_header_1_0(f)
        if 0 in shape:
            return np.zeros(shape, dtype=kind)
    return np.load(path, mmap_mode="r")


class Bigrams:
    """Counts of bigrams from the arrays of all ranges."""

    def __init__(self, folder: str, parts: list[int], total: int):
        self.arrays = {p: [_array(folder, f"b{p}-{x}") for x in ("key", "small", "big")] for p in parts}
        self.bounds = bounds(total)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted ``keys`` (0: never seen)."""
        out = np.zeros(len(keys), dtype=np.int64)
        edge = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for p, (key, small, big) in self.arrays.items():
            mine = slice(edge[p], edge[p + 1])
            if mine.start == mine.stop:
                continue
            at = np.minimum(np.searchsorted(key, keys[mine]), len(key) - 1)
            n = np.where(key[at] == keys[mine], small[at], 0).astype(np.int64)
            more = np.flatnonzero(n == SMALL)
            if len(more):
                n[more] = big[1][np.searchsorted(big[0], at[more])]
            out[mine] = n
        return out


class Words:
    """Count, number of different words before (k) and gamma of words, from all ranges."""

    def __init__(self, folder: str, parts: list[int], total: int):
        self.arrays = {p: [_array(folder, f"w{p}-{x}") for x in ("key", "count", "kinds", "gamma")] for p in parts}
        self.bounds = bounds(total)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys))
        edge = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for p, (key, *columns) in self.arrays.items():
            mine = slice(edge[p], edge[p + 1])
            if mine.start == mine.stop:
                continue
            at = np.minimum(np.searchsorted(key, keys[mine]), len(key) - 1)
            hit = key[at] == keys[mine]
            for o, c in zip(out, columns, strict=True):
                o[mine] = np.where(hit, c[at], 0)
        return out


_mapped: dict = {}


def _mapping(kind: type, folder: str, parts: list[int], total: int):
    """The arrays of one model, mapped once per worker."""
    key = (kind.__name__, folder)
    if key not in _mapped:
        for other in [k for k in _mapped if k[0] == kind.__name__]:
            del _mapped[other]
        _mapped[key] = kind(folder, parts, total)
    return _mapped[key]


def _word_statistics(folder: str, parts: list[int], total: int) -> Callable:
    """Per run and word: occurrences, shares of the different words before it, and shares of the
    bigrams of count 1, 2 and more that it begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bigrams = _mapping(Bigrams, folder, parts, total)
        for before, word in _runs(batches, RUN_TOKENS):
            keys, first, n = np.unique(bigram_key(before, word), return_index=True, return_counts=True)
            c = bigrams.counts(keys)
            share = n / c
            words, place = np.unique(np.concatenate((before[first], word[first])), return_inverse=True)
            head, tail = place[:len(keys)], place[len(keys):]

            def summed(at, values, size=len(words)):
                return np.bincount(at, weights=values, minlength=size)

            count = np.where(words == START, summed(head, n), summed(tail, n)).astype(np.int64)
            yield _dealt(words, [count, summed(tail, share), *[summed(head, share * of) for of in
                                                               (c == 1, c == 2, c > 2)]], total)
    return run


STATISTICS = ["c0", "c1", "c2", "c3", "c4"]


def _store_words(folder: str, discounts: list[float]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (keys, *columns) in _by_part(batches, ["keys", *STATISTICS]):
            key, (count, kinds, *of) = _summed(keys, columns, [np.int64, *[np.float64] * 4])
            kinds, of = np.rint(kinds).astype(np.int64), np.rint(of)
            gamma = (np.array(discounts) @ of) / np.maximum(count, 1)
            for name, values in (("key", key), ("count", count), ("kinds", kinds), ("gamma", gamma)):
                _write(folder, f"w{part}-{name}", values)
            token = key != START
            yield pa.RecordBatch.from_pylist([{
                "part": part, "n": _counts_of_counts(kinds[token]), "different": int(token.sum()),
                "tokens": int(count[token].sum()), "kinds": int(kinds[token].sum())}])
    return run


def discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams of counts 1 to 4."""
    out = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0
        out.append(d if 0 < d < i else i / 2)
    return out


def discounted(n: np.ndarray, d: list[float]) -> np.ndarray:
    """max(n - d(n), 0)."""
    return np.maximum(n - np.array([0.0, *d])[np.minimum(n, 3)], 0)


class Model:
    """What the driver knows of a fitted model: where its arrays are, and one number per total."""

    def __init__(self, folder: str, total: int, bigram_parts: list, word_parts: list, d: list[float], e: list[float],
                 different: int, train_tokens: int, kinds: int, delta: float):
        self.folder, self.total, self.bigram_parts, self.word_parts = folder, total, bigram_parts, word_parts
        self.d, self.e, self.different, self.train_tokens = d, e, different, train_tokens
        self.kinds, self.delta = kinds, delta

    def probabilities(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """p(word | before) and the training count of every token."""
        bigrams = _mapping(Bigrams, self.folder, self.bigram_parts, self.total)
        words = _mapping(Words, self.folder, self.word_parts, self.total)
        keys, first, back = np.unique(bigram_key(before, word), return_index=True, return_inverse=True)
        c = bigrams.counts(keys)
        known, place = np.unique(np.concatenate((before[first], word[first])), return_inverse=True)
        count, kinds, gamma = words.find(known)
        head, tail = place[:len(keys)], place[len(keys):]
        single = discounted(kinds, self.e) / max(self.kinds, 1) + self.delta / (self.different + 1)
        p = np.where(count[head] > 0, discounted(c, self.d) / np.maximum(count[head], 1)
                     + gamma[head] * single[tail], single[tail])
        # START is a key of the word arrays, but no token.
        return p[back], np.where(known == START, 0, count)[tail][back]


def _folder(spark: SparkSession) -> str:
    where = urlparse(checkpoint_dir(spark))
    if where.scheme not in ("", "file"):
        raise ValueError("The model is memory-mapped: spark.checkpoint.dir must be a mounted folder (file:...), "
                         f"not {where.scheme}:.")
    folder = os.path.join(where.path, f"lm-{uuid.uuid4().hex}")
    os.makedirs(folder)
    return folder


def fit(docs: DataFrame) -> Model:
    """The model of all texts of ``docs`` (null: empty). Its counts grow with the texts; the driver
    gets one row of totals per range of hashes."""
    spark = docs.sparkSession
    common.prepare(spark)
    folder, total = _folder(spark), common.shuffle_partitions(spark)
    texts = common.documents(docs).select("text")
    stored = (texts.mapInArrow(_count_bigrams(total), "part int, keys binary, c0 binary")
              .repartitionById(total, "part").sortWithinPartitions("part")
              .mapInArrow(_store_bigrams(folder), "part long, n array<long>").collect())
    bigram_parts = sorted(r.part for r in stored)
    of = [sum(x) for x in zip(*[r.n for r in stored], strict=True)] or [0] * 5
    d = discounts(of)
    schema = "part int, keys binary, " + ", ".join(f"{c} binary" for c in STATISTICS)
    words = (texts.mapInArrow(_word_statistics(folder, bigram_parts, total), schema)
             .repartitionById(total, "part").sortWithinPartitions("part")
             .mapInArrow(_store_words(folder, d), "part long, n array<long>, different long, tokens long, kinds long")
             .collect())
    of = [sum(x) for x in zip(*[r.n for r in words], strict=True)] or [0] * 5
    e = discounts(of)
    kinds = sum(r.kinds for r in words)
    delta = (e[0] * of[0] + e[1] * of[1] + e[2] * of[4]) / kinds if kinds else 1.0
    return Model(folder, total, bigram_parts, sorted(r.part for r in words), d, e, sum(r.different for r in words),
                 sum(r.tokens for r in words), kinds, delta)


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double, perplexity double")


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        open_ = np.zeros(4)   # sums of a text of which more slices follow

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, n, open_
            before, word = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            p, count = model.probabilities(before, word)
            log_p = np.log10(p)
            base = np.log10((count + 0.5) / (model.train_tokens + 0.5 * (model.different + 1)))
            at = 0
            for b, _, row, piece, ends in held:
                s = slice(at, at + len(b))
                at += len(b)
                sums = np.stack([np.bincount(row, weights=w, minlength=piece.num_rows) for w in
                                 (np.ones(len(b)), count[s] > 0, base[s], log_p[s])])
                sums[:, 0] += open_
                open_ = np.zeros(4) if ends else sums[:, 0]
                if not ends:
                    continue
                tokens_, known = (x.astype(np.int64) for x in sums[:2])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("held_out"), pa.array(tokens_), pa.array(known),
                     pa.array(np.full(len(tokens_), model.train_tokens)), pa.array(sums[2]), pa.array(sums[3]),
                     pa.array(10.0 ** np.minimum(-sums[3] / tokens_, 300))], [c.split()[0] for c in SCORES.split(", ")])
            held, n = [], 0

        for item in tokens(batches):
            held.append(item)
            n += len(item[1])
            if n >= SCORE_TOKENS:
                yield from flush()
        if held:
            yield from flush()
    return run


def scored(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row
    of ``docs``; the model is fitted on the rows where the column ``held_out`` is false.

    Nulls: a null text is empty (one token, the end); a null doc_id has the fold of the empty
    string. Repeated rows each count. No training rows: every token has probability 1 (score 0).
    Empty table: no rows. Other columns are ignored, whatever their names. Texts are read whole;
    very long ones in slices, one at a time.
    """
    base = common.documents(docs, held_out.alias("held_out"))
    model = fit(base.where(~F.col("held_out")))
    return base.mapInArrow(_score(model), SCORES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(common.table(spark, sf_dir, "documents"), fold(HELD_MODULUS) == HELD_VALUE)
