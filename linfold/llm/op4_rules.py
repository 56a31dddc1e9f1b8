"""Quality rules: rule statistics of every text, and an isolation forest on them.

Words are runs of bytes other than space and 0x09-0x0D. The base rules fail a document with fewer
than 20 words, or with over 30 % of its words in 8-word windows that occur twice or more in it.

The forest isolates documents by random splits of the rule statistics. A node is split at a random
value of a random statistic until its rows are alone or ``DEPTH`` splits deep. The value is drawn
from the node's whole box, which starts as the range of all labelled rows, so that a statistic which
is 0 in good documents can be split on too. No split depends on the rows inside the box: the splits
of the ``TREES`` trees are drawn first, and a pass counts all good labelled documents in their nodes.
A document's score is 2 ** (-mean path length / expected path length): anomalous documents are
isolated early and score high. The threshold is the one that costs least on all labelled documents,
where a rejected good document costs ``CLEAN_COST`` times as much as a kept bad one; without bad
documents nothing is rejected by score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import common, labels as lab
from linfold.llm.textbytes import Texts, chunks, covered, repeated_in_row, window_hash, windows

MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"   # fixed values of the contract
TREES, DEPTH, SEED = 100, 12, 4
CLEAN_COST = 10

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_known_words", "n_upper", "n_marks")
COUNTS_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)
SCORE_ROWS = 2048   # rows scored at a time


def _byte_set(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


_SYMBOL = _byte_set(SYMBOLS)
_UPPER = _byte_set(bytes(range(65, 91)))
_MARK = _byte_set(b"!?")


def rule_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The ``COUNTS`` of each text (null: empty). n_lines: lines with a word; n_known_words: words
    that occur earlier in the text; n_upper: A-Z; n_marks: ! and ?."""
    t = Texts(texts)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[t.row_end] - total[t.row_start]

    prefix = t.prefix()
    word_bytes = np.concatenate(([0], np.cumsum(t.is_word, dtype=np.int64)))
    stop = np.flatnonzero(t.buf == 10)
    begin = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
    full = word_bytes[stop] > word_bytes[begin]
    begin, stop = begin[full], stop[full]
    line_row = np.searchsorted(t.row_end, stop)
    _, again = repeated_in_row(t.span_hash(begin, stop, prefix), line_row)
    word_row = t.row_of_word()
    hashes = t.span_hash(t.start, t.end, prefix)
    _, known = repeated_in_row(hashes, word_row)
    index, row = windows(t.first, REPEAT_WINDOW)
    twice, _ = repeated_in_row(window_hash(hashes, REPEAT_WINDOW)[index], row)
    repeated = covered(index[twice], REPEAT_WINDOW, len(hashes))

    def count(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=t.n).astype(np.int64)

    return {"n_words": t.n_words.astype(np.int64),
            "word_chars": per_row(t.is_word & ((t.buf & 0xC0) != 0x80)),
            "n_symbols": per_row(_SYMBOL[t.buf]), "n_dup_lines": count(line_row[again]),
            "n_repeat_words": count(word_row[repeated]), "n_lines": count(line_row),
            "n_known_words": count(word_row[known]), "n_upper": per_row(_UPPER[t.buf]),
            "n_marks": per_row(_MARK[t.buf])}


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics, one row a document."""
    words = np.maximum(c["n_words"], 1)
    return np.stack([np.log1p(c["n_words"]), np.log(np.maximum(c["word_chars"], 1) / words),
                     np.log1p(10 * c["n_symbols"] / words), c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
                     c["n_repeat_words"] / words, c["n_known_words"] / words,
                     c["n_upper"] / np.maximum(c["word_chars"], 1), np.log1p(10 * c["n_marks"] / words)], axis=1)


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    many = np.maximum(n, 3)
    return np.where(n > 2, 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many,
                    np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays, a row for each; the children of node i are 2 * i + 1 and 2 * i + 2. ``feature``
    -1 marks a leaf, whose ``length`` is its path length, grown on ``rows`` documents."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    rows: int

    @staticmethod
    def splits(low: np.ndarray, high: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
        """Random splits of the box from ``low`` to ``high``, ``depth`` levels; no rows."""
        rng = np.random.default_rng(seed)
        size = 2 ** (depth + 1) - 1
        feature, value = np.full((trees, size), -1, np.int8), np.zeros((trees, size))
        lo, hi = (np.tile(x, (trees, 1, 1)) for x in (low, high))
        for level in range(depth):
            nodes = slice(2 ** level - 1, 2 ** (level + 1) - 1)
            wide = hi > lo
            f = np.where(wide, rng.random(wide.shape), -1.0).argmax(axis=2)[..., None]
            here_lo, here_hi = (np.take_along_axis(x, f, 2) for x in (lo, hi))
            at = here_lo + rng.random(f.shape) * (here_hi - here_lo)
            feature[:, nodes] = np.where(wide.any(axis=2), f[..., 0], -1)
            value[:, nodes] = at[..., 0]
            below, above = hi.copy(), lo.copy()
            np.put_along_axis(below, f, at, 2)
            np.put_along_axis(above, f, at, 2)
            lo, hi = (np.stack(x, axis=2).reshape(trees, 2 ** (level + 1), -1) for x in ((lo, above), (below, hi)))
        return Forest(feature, value, np.zeros((trees, size)), 0)

    def grown(self, counts: np.ndarray, rows: int) -> Forest:
        """The trees on ``rows`` documents, of which ``counts`` of each tree end in each node."""
        trees, size = self.feature.shape
        depth = (size + 1).bit_length() - 2
        inside = counts.astype(np.int64)
        for level in range(depth, 0, -1):
            nodes = slice(2 ** level - 1, 2 ** (level + 1) - 1)
            inside[:, 2 ** (level - 1) - 1:2 ** level - 1] += inside[:, nodes].reshape(trees, -1, 2).sum(axis=2)
        levels = np.repeat(np.arange(depth + 1), 2 ** np.arange(depth + 1))
        return Forest(np.where(inside <= 1, -1, self.feature).astype(np.int8), self.value,
                      levels + expected_path(inside), rows)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree (rows, trees), numbered through all trees."""
        trees, size = self.feature.shape
        feature, value = self.feature.ravel(), self.value.ravel()
        root = np.arange(trees) * size
        at = np.tile(root, (len(x), 1))
        row = np.arange(len(x))[:, None]
        while True:
            f = feature[at]
            if not (f >= 0).any():
                return at
            right = x[row, np.maximum(f, 0)] > value[at]
            at = np.where(f >= 0, 2 * at - root + 1 + right, at)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row, 0 to 1."""
        length = self.length.ravel()
        mean = [length[self.nodes(x[i:i + SCORE_ROWS])].mean(axis=1) for i in range(0, len(x), SCORE_ROWS)]
        return 2.0 ** (-np.concatenate([*mean, np.zeros(0)]) / max(float(expected_path(self.rows)), 1e-9))


def threshold(costs: DataFrame) -> float:
    """The cut with the least cost over rows (score, cost of rejecting it; score >= cut: rejected);
    infinity if rejecting nothing costs least. The driver gets one row per partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first, least, best, after = 0, None, None, None, None
        for batch in batches:
            score, cost = (batch.column(c).to_numpy() for c in ("score", "cost"))
            if not len(score):
                continue
            first = score[0] if first is None else first
            if best is not None and after is None:
                after = score[0]
            running = total + np.cumsum(cost)
            at = int(np.argmin(running))
            if least is None or running[at] < least:
                least, best = running[at], score[at]
                after = score[at + 1] if at + 1 < len(score) else None
            total = running[-1]
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((first, pa.float64()), (total, pa.int64()), (least, pa.int64()),
                                               (best, pa.float64()), (after, pa.float64()))],
                ["first", "total", "least", "best", "after"])

    parts = common.shuffle_partitions(costs.sparkSession)
    down = F.col("score").desc()
    found = (costs.groupBy("score").agg(F.sum("cost").alias("cost"))   # ties are rejected together
             .repartitionByRange(parts, down).sortWithinPartitions(down)
             .mapInArrow(run, "first double, total long, least long, best double, after double").collect())
    found.sort(key=lambda r: -r.first)
    total, least, cut = 0, 0, float("inf")
    for i, r in enumerate(found):
        if total + r.least < least:
            after = r.after if r.after is not None else found[i + 1].first if i + 1 < len(found) else r.best
            least, cut = total + r.least, (r.best + after) / 2
        total += r.total
    return cut


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches):
        c = rule_counts(part.column("text"))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c[k]) for k in COUNTS]],
                                         ["doc_id", *COUNTS])


def _counts(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {k: batch.column(k).to_numpy() for k in COUNTS}


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


@dataclass
class Rules:
    """What the labelled rows taught: a forest (None without labelled rows) and a threshold."""

    forest: Forest | None
    cut: float

    def judge(self, c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """base_failed, anomaly and kept of documents with these counts."""
        failed = base_failed(c["n_words"], c["n_repeat_words"])
        score = self.forest.score(features(c)) if self.forest else np.zeros(len(failed))
        return failed, score, ~failed & (score < self.cut)


def _box(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each statistic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = features(_counts(batch))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(x.min(axis=0)), pa.array(x.max(axis=0))],
                    ["f", "low", "high"])

    found = (rows.mapInArrow(run, "f int, low double, high double").groupBy("f")
             .agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas().sort_values("f"))
    return found["low"].to_numpy(), found["high"].to_numpy()


def _grown(splits: Forest, rows: DataFrame, n: int) -> Forest:
    """``splits`` with all ``n`` rows counted. The driver gets a number per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.zeros(splits.feature.size, np.int64)
        for batch in batches:
            x = features(_counts(batch))
            for i in range(0, len(x), SCORE_ROWS):
                inside += np.bincount(splits.nodes(x[i:i + SCORE_ROWS]).ravel(), minlength=len(inside))
        node = np.flatnonzero(inside)
        yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), pa.array(inside[node])], ["node", "n"])

    found = rows.mapInArrow(run, "node int, n long").groupBy("node").agg(F.sum("n").alias("n")).toPandas()
    inside = np.zeros(splits.feature.size, np.int64)
    inside[found["node"].to_numpy()] = found["n"].to_numpy()
    return splits.grown(inside.reshape(splits.feature.shape), n)


def _taught(docs: DataFrame, labels: DataFrame) -> tuple[Rules, DataFrame]:
    """What all labelled rows teach, and doc_id, ``COUNTS``, base_failed, anomaly of every row."""
    common.prepare(docs.sparkSession)
    counted = common.documents(docs).mapInArrow(_count_batches, f"doc_id long, {COUNTS_SCHEMA}")
    counted = common.saved(counted.join(lab.known(labels, "quality"), "doc_id", "left"), "rule-counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    taught = counted.where("label IS NOT NULL")
    grows = taught.where((F.col("label") == 1) & ~failed)
    n = taught.count()
    forest = None
    if n:
        good = grows.count()
        forest = _grown(Forest.splits(*_box(taught)), grows if good else taught, good or n)
    judge = Rules(forest, float("inf")).judge

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, score, _ = judge(_counts(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base), pa.array(score)],
                                             [*batch.schema.names, "base_failed", "anomaly"])

    scored = common.saved(counted.mapInArrow(run, f"doc_id long, {COUNTS_SCHEMA}, label int, base_failed boolean, "
                                                  "anomaly double"), "rule-scores")
    costs = (scored.where("label IS NOT NULL AND NOT base_failed")
             .select(F.col("anomaly").alias("score"), F.when(F.col("label") == 1, CLEAN_COST).otherwise(-1).alias("cost")))
    return Rules(forest, threshold(costs)), scored.drop("label")


def learn(docs: DataFrame, labels: DataFrame) -> Rules:
    """Forest and threshold from the texts of all labelled documents."""
    return _taught(docs, labels)[0]


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the ``COUNTS``, base_failed, anomaly, kept for every row of ``docs``.

    Nulls: a null text is an empty one (base_failed); a null doc_id stays null and is never a
    labelled row. Ties and repeated rows are judged alike, each row by itself. Empty documents:
    no rows. Empty labels: only the base rules reject. Other columns are ignored. Texts of any
    length are taken whole.
    """
    rules, scored = _taught(docs, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(rules.cut)))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``judged`` keeps."""
    rules = learn(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield part.filter(pa.array(rules.judge(rule_counts(part.column("text")))[2]))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "anomaly")
