"""Hard-negative mining with segment summaries.

Vectors hold integers (``floor(256 * x)``); a score is an inner product. An anchor's positives are
its best rows of the same label; its hard negatives are the best rows of other labels whose scores
lie between a low and a high share of a positive's score.

Segment summary filtering: a vector is cut into segments of m components, and each keeps its mean
and deviation. The product of two segments lies within m * (mean * mean' -+ dev * dev'), so the sum
over the segments bounds a score from both sides. Pairs whose bounds miss the scores still wanted
are dropped; the others are bounded again by segments half as long (``LEVELS``), and what is left
is scored exactly. Wanted are scores no worse than the last of the best found so far by the task,
and within the limits of the positives.

On Spark: the anchors are a stated query set against all rows. Anchors are dealt to groups of about
``ANCHOR_BLOCK``, rows to so many groups that there is a cell (anchor group, row group) per shuffle
partition, but ``CELL_ROWS`` rows a cell at least. A cell streams its rows in blocks past its anchors
and returns the best per anchor, so that a cell's memory does not grow with its rows. Rows are dealt by a row number, whatever their labels or vectors. The best
of all cells are ranked per anchor (positives first, then negatives).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linfold.llm import common

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90             # a negative's score, in hundredths of the positive's
ANCHOR_BLOCK = 16_384
CELL_ROWS = 4_096
ROW_BLOCK, ANCHOR_TILE = 2_048, 1_024
LEVELS = (4, 8, 16)            # segments per vector
LARGEST = (1 << 31) - 1
EXACT = 1 << 53                # integers up to here are exact in float64 products
WORST = np.iinfo(np.int64).min
SPARSE = 8                     # pairs are gathered where fewer than 1 in so many is left (speed only)


class Vectors:
    """Row number, id, label and components of some rows, with their segment summaries."""

    def __init__(self, r: np.ndarray, vec_id: np.ndarray, label: np.ndarray, parts: list[bytes]):
        self.r, self.vec_id, self.label = r, vec_id, label
        sizes = [len(p) // 4 for p in parts]
        width = -(-max(sizes, default=1) // LEVELS[-1]) * LEVELS[-1] or LEVELS[-1]
        self.q = np.zeros((len(parts), width), dtype=np.int64)
        for row, (p, n) in enumerate(zip(parts, sizes, strict=True)):
            self.q[row, :n] = np.frombuffer(p, dtype="<i4")
        self._summarise()

    def _summarise(self) -> None:
        self.x = self.q.astype(np.float64)
        self.largest = float(np.abs(self.x).max(initial=0))
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.mean, self.dev = [], []
        for segments in LEVELS:
            cut = self.x.reshape(len(self.x), segments, -1)
            root = np.sqrt(cut.shape[2])
            self.mean.append(cut.mean(axis=2) * root)
            self.dev.append(cut.std(axis=2) * root)

    def take(self, index: np.ndarray) -> Vectors:
        out = object.__new__(Vectors)
        for name in ("r", "vec_id", "label", "q", "x", "norm"):
            setattr(out, name, getattr(self, name)[index])
        out.largest = self.largest
        out.mean, out.dev = [m[index] for m in self.mean], [d[index] for d in self.dev]
        return out

    def widened(self, width: int) -> Vectors:
        """The same rows with zeros up to ``width`` components."""
        if self.q.shape[1] == width:
            return self
        out = object.__new__(Vectors)
        out.r, out.vec_id, out.label = self.r, self.vec_id, self.label
        out.q = np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))
        out._summarise()
        return out


def _products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of ``a`` and j of ``b``."""
    if len(i) * SPARSE >= len(a) * len(b):
        return (a @ b.T)[i, j]
    out = np.empty(len(i), dtype=a.dtype)
    step = 1 << 16
    for at in range(0, len(i), step):
        s = slice(at, at + step)
        out[s] = np.einsum("ij,ij->i", a[i[s]], b[j[s]])
    return out


def scored(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray, low: np.ndarray, high: np.ndarray,
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (i of ``a``, j of ``b``) those whose score is at least ``low`` and at most
    ``high`` (per row of ``a``), with their exact scores."""
    for level in range(len(LEVELS)):
        if not len(i):
            break
        middle = _products(a.mean[level], b.mean[level], i, j)
        spread = _products(a.dev[level], b.dev[level], i, j)
        spread += 1e-9 * a.norm[i] * b.norm[j] + 1   # more than the rounding of the bounds
        keep = (middle + spread >= low[i]) & (middle - spread <= high[i])
        i, j = i[keep], j[keep]
    if a.largest * b.largest * a.q.shape[1] < EXACT:
        score = np.rint(_products(a.x, b.x, i, j)).astype(np.int64)
    else:
        score = _products(a.q, b.q, i, j)
    keep = (score >= low[i]) & (score <= high[i])
    return i[keep], j[keep], score[keep]


class Best:
    """The ``k`` best (score, id, row number) per key seen so far."""

    def __init__(self, keys: int, k: int):
        self.k, self.last = k, np.full(keys, WORST)
        self.key = self.score = self.vec_id = self.r = np.zeros(0, dtype=np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, vec_id: np.ndarray, r: np.ndarray) -> None:
        new = score >= self.last[key]
        if not new.any():
            return
        key, score, vec_id, r = (np.concatenate((held, x[new])) for held, x in (
            (self.key, key), (self.score, score), (self.vec_id, vec_id), (self.r, r)))
        order = np.lexsort((r, vec_id, -score, key))
        key = key[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        rank = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        kept = order[rank < self.k]
        self.key, self.score, self.vec_id, self.r = key[rank < self.k], score[kept], vec_id[kept], r[kept]
        full = rank == self.k - 1
        self.last[key[full]] = score[order[full]]


class _Positives:
    """The best rows of the same label of a cell's anchors."""

    schema = "anchor_r long, anchor_id long, id long, r long, score long"

    def __init__(self, anchors: Vectors, extra: list, k: int):
        self.anchors, self.best = anchors, Best(len(anchors.r), k)
        order = np.argsort(anchors.label, kind="stable")
        edges = np.flatnonzero(np.diff(anchors.label[order])) + 1
        self.of = {int(anchors.label[p[0]]): p for p in np.split(order, edges) if len(p)}

    def block(self, rows: Vectors) -> None:
        for label in np.unique(rows.label).tolist():
            place = self.of.get(label)
            if place is None:
                continue
            mine = rows.take(np.flatnonzero(rows.label == label))
            for at in range(0, len(place), ANCHOR_TILE):
                own = place[at:at + ANCHOR_TILE]
                a = self.anchors.take(own)
                i, j = np.nonzero(a.r[:, None] != mine.r[None, :])
                i, j, score = scored(a, mine, i, j, self.best.last[own], np.full(len(own), np.inf))
                self.best.add(own[i], score, mine.vec_id[j], mine.r[j])

    def result(self) -> list[np.ndarray]:
        b = self.best
        return [self.anchors.r[b.key], self.anchors.vec_id[b.key], b.vec_id, b.r, b.score]


class _Negatives:
    """The best rows of other labels within the limits of each positive of a cell's anchors.
    ``extra``: per anchor the positives' (nth, id, score)."""

    schema = ("anchor_r long, anchor_id long, nth int, positive_id long, positive_score long, id long, r long, "
              "score long")

    def __init__(self, anchors: Vectors, extra: list, k: int, low: int, high: int):
        self.anchors = anchors
        flat = [(a, p["nth"], p["id"], p["score"]) for a, ps in enumerate(extra) for p in ps]
        self.anchor, self.nth, self.positive, self.score = np.array(flat, dtype=np.int64).reshape(-1, 4).T
        # 100 * s >= low * p and 100 * s <= high * p, rounded into whole scores
        self.low, self.high = -((-low * self.score) // 100), (high * self.score) // 100
        self.best = Best(len(flat), k)
        self.best.last = self.low.copy()
        self.first = np.searchsorted(self.anchor, np.arange(len(anchors.r) + 1))

    def block(self, rows: Vectors) -> None:
        lo = np.full(len(self.anchors.r), np.iinfo(np.int64).max)
        hi = np.full(len(self.anchors.r), WORST)
        open_ = self.best.last <= self.high
        np.minimum.at(lo, self.anchor[open_], self.best.last[open_])
        np.maximum.at(hi, self.anchor[open_], self.high[open_])
        wanted = np.flatnonzero(lo <= hi)
        for at in range(0, len(wanted), ANCHOR_TILE):
            own = wanted[at:at + ANCHOR_TILE]
            a = self.anchors.take(own)
            i, j = np.nonzero(a.label[:, None] != rows.label[None, :])
            i, j, score = scored(a, rows, i, j, lo[own], hi[own])
            for nth in range(int(np.diff(self.first)[own].max(initial=0))):
                key = self.first[own][i] + nth
                fits = key < self.first[own + 1][i]
                key = key[fits]
                inside = (score[fits] >= self.low[key]) & (score[fits] <= self.high[key])
                pick = np.flatnonzero(fits)[inside]
                self.best.add(key[inside], score[pick], rows.vec_id[j[pick]], rows.r[j[pick]])

    def result(self) -> list[np.ndarray]:
        b, a = self.best, self.anchor[self.best.key]
        return [self.anchors.r[a], self.anchors.vec_id[a], self.nth[b.key].astype(np.int32),
                self.positive[b.key], self.score[b.key], b.vec_id, b.r, b.score]


def _cells(make: Callable) -> Callable:
    """Runs ``make(anchors, extra)`` over every cell: its anchors first, then its rows in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, anchors, work, held = None, [], None, []

        def vectors(rows: list) -> Vectors:
            r, i, label = (np.array([x[c] for x in rows], dtype=np.int64) for c in range(3))
            return Vectors(r, i, label, [x[3] for x in rows])

        def block() -> None:
            nonlocal work, held
            if not held or not anchors:
                held = []
                return
            if work is None:
                work = make(vectors(anchors), [x[4] for x in anchors])
            rows = vectors(held)
            width = max(rows.q.shape[1], work.anchors.q.shape[1])
            work.anchors = work.anchors.widened(width)
            work.block(rows.widened(width))
            held = []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal anchors, work
            block()
            if work is not None:
                columns = work.result()
                names = [c.split()[0] for c in work.schema.split(", ")]
                for at in range(0, len(columns[0]), 8192):
                    yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 8192]) for c in columns], names)
            anchors, work = [], None

        names = ["r", "vec_id", "label", "q", "extra"]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "is_row", *names)]
            for c, is_row, *row in zip(*columns, strict=True):
                if c != cell:
                    yield from close()
                    cell = c
                if is_row:
                    held.append(row)
                    if len(held) >= ROW_BLOCK:
                        block()
                else:
                    anchors.append(row)
        yield from close()

    return run


def _over_cells(anchors: DataFrame, rows: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make`` over all cells of ``anchors`` (r, vec_id, label, q, extra) and ``rows`` (r, vec_id, label, q)."""
    spark = rows.sparkSession
    groups = common.partitions_for(anchors.count(), ANCHOR_BLOCK, 1)
    parts = min(-(-common.shuffle_partitions(spark) // groups), common.partitions_for(rows.count(), CELL_ROWS, 1))
    at = lambda n: F.pmod(F.xxhash64("r"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["r", "vec_id", "label", "q"]
    left = (anchors.select(*columns, "extra", at(groups).alias("a"), each(parts).alias("b"))
            .select((F.col("a") * parts + F.col("b")).alias("cell"), F.lit(False).alias("is_row"), *columns, "extra"))
    right = (rows.select(*columns, each(groups).alias("a"), at(parts).alias("b"))
             .select((F.col("a") * parts + F.col("b")).alias("cell"), F.lit(True).alias("is_row"), *columns,
                     F.lit(None).cast(anchors.schema["extra"].dataType).alias("extra")))
    return (left.union(right).repartitionById(groups * parts, "cell").sortWithinPartitions("cell", "is_row")
            .mapInArrow(_cells(make), schema))


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as little-endian 32-bit integers floor(256 * x); rows with other components go."""
    for batch in batches:
        column = batch.column("embedding")
        values = np.asarray(column.values.cast(pa.float64()).fill_null(np.nan))
        bounds = np.asarray(column.offsets)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        with np.errstate(invalid="ignore", over="ignore"):
            q = np.clip(np.nan_to_num(np.floor(256 * values)), -LARGEST, LARGEST).astype("<i4")
        keep = np.flatnonzero(bad[bounds[1:]] == bad[bounds[:-1]])
        parts = [q[bounds[i]:bounds[i + 1]].tobytes() for i in keep.tolist()]
        index = pa.array(keep)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(index), batch.column("label").take(index), pa.array(parts, pa.binary())],
            ["vec_id", "label", "q"])


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``vectors``
    (vec_id, embedding, label); anchors are the rows where ``anchor`` (of vec_id) is true.

    Nulls: rows with a null vec_id, label or vector, or any null or non-finite component, take no
    part. Ties: the smaller vec_id comes first. Repeated rows and ids: every row counts, as anchor
    too; a row is never its own positive. Vectors of different lengths: the shorter one ends in
    zeros; an empty one scores 0 with all. Components beyond +-(2**31 - 1) count as that; inner
    products beyond 64 bits wrap. Fewer rows than asked for: all of them. Empty table: no rows.
    Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding")).dropna()
    rows = common.saved(base.mapInArrow(_quantised, "vec_id long, label long, q binary")
                        .withColumn("r", F.monotonically_increasing_id()), "negatives-rows")
    anchors = rows.where(anchor)
    found = _over_cells(anchors.withColumn("extra", F.lit(None).cast("int")), rows,
                        lambda a, extra: _Positives(a, extra, positives), _Positives.schema)
    order = Window.partitionBy("anchor_r").orderBy(F.col("score").desc(), "id", "r")
    best = (found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
            .groupBy("anchor_r").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("extra")))
    known = common.saved(anchors.join(best, F.col("r") == F.col("anchor_r")).drop("anchor_r"), "negatives-positives")
    pairs = _over_cells(known, rows, lambda a, extra: _Negatives(a, extra, negatives, low, high), _Negatives.schema)
    order = Window.partitionBy("anchor_r", "nth").orderBy(F.col("score").desc(), "id", "r")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where vec_id is divisible by 7 the label first becomes (label + 1) % 10; anchors are the rows
    whose vec_id is divisible by 100."""
    vectors = common.table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id AS id, v.label,
         list_dot_product(a.q, v.q)::BIGINT AS score
  FROM v AS a, v WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s
  WHERE label = anchor_label AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
