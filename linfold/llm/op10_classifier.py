"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every word gives two terms: itself (ASCII lower case) and its shape (runs of capitals, other
letters, digits and single marks: "Of%%%" is "Aa%"). Terms are hashed into a fixed number of
buckets. A bucket's index vector is a fixed sparse random vector of +1 and -1; its word vector is
the sum of the index vectors of all terms within two words of its occurrences in the whole corpus
(random indexing), made a unit vector after the mean is taken off. The corpus counts are integers,
summed by Spark bucket by bucket, so they do not depend on the partitioning. The table of word
vectors has a fixed size (``BUCKETS`` x ``DIM``) and is sent to the tasks.

A document's input is the mean and the spread of its terms' vectors, words and shapes apart, and
its length. A two-layer numpy network is trained on a bounded sample of labelled documents; a part
of the sample, unused in training, gives the temperature that calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common, labels as lab
from linfold.llm.textbytes import BASE, BASE_INV, BYTE_VALUE, U64, Texts, chunks, mix

DIM, WORD_BUCKETS, SHAPE_BUCKETS = 32, 1 << 14, 1 << 10
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
NONZERO, REACH = 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 40, 256, 3e-3, 1e-4, 10
FLUSH_BYTES = 256 << 20

_KIND = np.full(256, 3, dtype=np.uint8)      # marks
_KIND[65:91] = 0                             # capitals
_KIND[97:123] = 1
_KIND[128:] = 1                              # other letters
_KIND[48:58] = 2                             # digits


def index_vectors() -> np.ndarray:
    """The fixed index vectors of all buckets: ``NONZERO`` of ``DIM`` places are +1 or -1."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIM), dtype=np.int8)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO)), axis=1)
    return out


def shape_hash(t: Texts) -> np.ndarray:
    """Hash of each word's shape: its kinds of characters, each run of one kind or mark once."""
    if not len(t.start):
        return np.zeros(0, dtype=U64)
    kind = _KIND[t.buf]
    code = np.where(kind == 3, t.buf, kind)
    first = np.empty(len(code), dtype=bool)
    first[0] = True
    first[1:] = code[1:] != code[:-1]
    first[t.start] = True
    first &= t.is_word
    place = np.flatnonzero(first)
    power = np.full(len(place) + 1, BASE, dtype=U64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.concatenate((np.zeros(1, U64), np.cumsum(BYTE_VALUE[code[place]] * power[:-1])))
    begin, stop = np.searchsorted(place, t.start), np.searchsorted(place, t.end)
    inverse = np.full(len(place) + 1, BASE_INV, dtype=U64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    return mix((total[stop] - total[begin]) * inverse[begin] + (stop - begin).astype(U64))


def terms(texts: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray]:
    """The texts' words with the buckets of the words and of their shapes."""
    t = Texts(texts)
    shape = WORD_BUCKETS + (shape_hash(t) % U64(SHAPE_BUCKETS)).astype(np.int64)
    capital = (t.buf >= 65) & (t.buf <= 90)
    t.buf[capital] |= 32
    return t, (t.word_hash() % U64(WORD_BUCKETS)).astype(np.int64), shape


def context_sums(t: Texts, word: np.ndarray, shape: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each bucket, the sum of the index vectors around its occurrences, and their number."""
    out = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    if not len(word):
        return out
    own = vectors[word] + vectors[shape]
    around = np.zeros((len(word), DIM), dtype=np.int16)
    row = t.row_of_word()
    for step in range(1, REACH + 1):
        same = (row[step:] == row[:-step]).astype(np.int8)[:, None]
        around[step:] += own[:-step] * same
        around[:-step] += own[step:] * same
    for bucket in (word, shape):
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        sorted_bucket = bucket[order]
        begin = np.flatnonzero(np.concatenate(([True], sorted_bucket[1:] != sorted_bucket[:-1])))
        out[sorted_bucket[begin], :DIM] += np.add.reduceat(around[order], begin, axis=0, dtype=np.int64)
        out[sorted_bucket[begin], DIM] += np.diff(np.append(begin, len(bucket)))
    return out


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vectors = index_vectors()
    total, read = np.zeros((BUCKETS, DIM + 1), dtype=np.int64), 0

    def rows(total: np.ndarray) -> pa.RecordBatch:
        used = np.flatnonzero(total[:, DIM])
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)),
                                           *[pa.array(total[used, d]) for d in range(DIM + 1)]],
                                          ["bucket", *[f"d{d}" for d in range(DIM + 1)]])

    for part in chunks(batches):
        t, word, shape = terms(part.column("text"))
        total += context_sums(t, word, shape, vectors)
        read += len(t.buf)
        if read > FLUSH_BYTES:
            yield rows(total)
            total[:], read = 0, 0
    yield rows(total)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors of all buckets (float32, fixed size) from the whole corpus."""
    names = [f"d{d}" for d in range(DIM + 1)]
    sums = (common.documents(docs)
            .mapInArrow(_sum_batches, "bucket int, " + ", ".join(f"{c} long" for c in names))
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toPandas())   # BUCKETS rows at most
    mean = np.zeros((BUCKETS, DIM))
    rows = sums["bucket"].to_numpy()
    values = sums[names].to_numpy(dtype=np.float64).reshape(-1, DIM + 1)
    mean[rows] = values[:, :DIM] / np.maximum(values[:, DIM:], 1)
    for low, high in ((0, WORD_BUCKETS), (WORD_BUCKETS, BUCKETS)):
        inside = rows[(rows >= low) & (rows < high)]
        if len(inside):
            mean[inside] -= mean[inside].mean(axis=0)
    size = np.linalg.norm(mean, axis=1, keepdims=True)
    return (mean / np.maximum(size, 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Inputs of the network, one row a text; a text without words has zeros."""
    t, word, shape = terms(texts)
    out = np.zeros((t.n, 4 * DIM + 1), dtype=np.float32)
    rows = np.flatnonzero(t.n_words)
    if len(rows):
        n = t.n_words[rows][:, None]
        for k, bucket in enumerate((word, shape)):
            v = vectors[bucket]
            mean = np.add.reduceat(v, t.first[rows], axis=0) / n
            v *= v
            square = np.add.reduceat(v, t.first[rows], axis=0) / n
            out[rows, 2 * k * DIM:(2 * k + 1) * DIM] = mean
            out[rows, (2 * k + 1) * DIM:(2 * k + 2) * DIM] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[:, -1] = np.log1p(t.n_words)
    return out


@dataclass
class Network:
    """Two layers; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return (hidden @ self.w2 + self.b2) / self.temperature

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(self.logit(x.astype(np.float64)) / 2))

    @staticmethod
    def constant(width: int, rate: float) -> Network:
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
                       float(np.log(rate / (1 - rate))))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED) -> Network:
        """Adam on the log loss; every fifth row is kept for the temperature."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        held, used = order[::5], np.delete(order, np.s_[::5])
        if len(used) < 10 or len(np.unique(y[used])) < 2:
            return Network.constant(x.shape[1], float(y.mean()) if len(y) else 0.5)
        mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-2
        z = (x - mean) / scale
        params = [rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
            mixed = rng.permutation(used)
            for at in range(0, len(mixed), BATCH):
                rows = mixed[at:at + BATCH]
                a = z[rows] @ params[0] + params[1]
                hidden = np.maximum(a, 0)
                p = 0.5 * (1 + np.tanh((hidden @ params[2] + params[3]) / 2))
                error = (p - y[rows]) / len(rows)
                back = np.outer(error, params[2]) * (a > 0)
                grads = [z[rows].T @ back + DECAY * params[0], back.sum(axis=0),
                         hidden.T @ error + DECAY * params[2], np.array([error.sum()])]
                step += 1
                for p_, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p_ -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
        logit, label = net.logit(x[held]), y[held]

        def loss(t: float) -> float:
            q = logit / t
            return float(np.mean(np.logaddexp(0, q) - label * q))

        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
        return net


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.network.probability(pooled(texts, self.vectors))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", train: Column | None = None,
          sample_rows: int = lab.SAMPLE_ROWS) -> Classifier:
    """Word vectors from all ``docs``, the network from ``sample_rows`` labelled ones at most, of
    those rows of ``labels`` for which ``train`` holds."""
    common.prepare(docs.sparkSession)
    vectors = word_vectors(docs)
    chosen = lab.sample(labels, label, sample_rows, train)
    width = 4 * DIM + 1

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            x = pooled(part.column("text"), vectors)
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(pa.list_(pa.float32()))],
                ["label", "x"])

    known = (common.documents(docs).join(F.broadcast(chosen), "doc_id").select("text", "label")
             .mapInArrow(pool, "label int, x array<float>").toPandas())
    if known.empty:
        return Classifier(vectors, Network.constant(width, 0.5))
    x, y = np.stack(known["x"].to_numpy()).astype(np.float64), known["label"].to_numpy().astype(np.float64)
    order = np.lexsort(np.column_stack((x, y)).T)   # the same network whatever the order of arrival
    return Classifier(vectors, Network.fit(x[order], y[order]))


def scored(docs: DataFrame, labels: DataFrame, train: Column | None = None,
           sample_rows: int = lab.SAMPLE_ROWS) -> DataFrame:
    """doc_id, score (0 to 1) of every row of ``docs``.

    Nulls: a null text is an empty one, scored by its zeros; a null doc_id stays null and is never
    a labelled row. Repeated rows and ties get equal scores, row by row. Empty documents: no rows.
    Labels that are empty or of one kind: every score is that kind's rate (0.5 without labels).
    Other columns are ignored. Texts of any length are taken whole.
    """
    model = learn(docs, labels, train=train, sample_rows=sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(part.column("text")))],
                                             ["doc_id", "score"])

    return common.documents(docs).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, labels: DataFrame, least: float = 0.5, train: Column | None = None,
         sample_rows: int = lab.SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` (all columns) with a score of ``least`` or more."""
    model = learn(docs, labels, train=train, sample_rows=sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield part.filter(pa.array(model.score(part.column("text")) >= least))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> Column:
    return lab.fold(3) == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scored(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"), ~held_out())
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
