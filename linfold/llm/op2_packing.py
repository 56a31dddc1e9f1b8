"""Best-fit packing of tokenized documents into sequences.

A document is its ids and one end id. One longer than a sequence is cut: the first piece takes the
remainder, the others fill a sequence each, so that at most one piece per document has to share.
Pieces are dealt at random into groups of about ``GROUP_PIECES``, and each group is packed by
best-fit decreasing: pieces by falling length, each into the open sequence with the least room that
still holds it, found in a segment tree over the remaining capacities in logarithmic time. A group
leaves a sequence or two partly empty, so the number of sequences does not depend on the number of
documents in one task, and no task holds more than a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import bpe, common
from linfold.llm.textbytes import chunks

SEQUENCE, END_ID = 2048, 0
GROUP_PIECES = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Capacities:
    """Open sequences by remaining capacity: a segment tree that counts those in each range."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._add(capacity, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, number) of the tightest sequence with room for ``need``."""
        count = self.count
        node = need + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.bins[capacity].pop()


def best_fit(length: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the given order (falling length)."""
    number, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    open_ = Capacities(sequence)
    made = 0
    for i, need in enumerate(length.tolist()):
        found = open_.take_tightest(need)
        if found is None:
            found = (sequence, made)
            made += 1
        room, number[i] = found
        offset[i] = sequence - room
        if room > need:
            open_.put(room - need, int(number[i]))
    return number, offset


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path = path or bpe.default_path()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder.get(path)
        for part in chunks(batches):
            rows: list[tuple[int | None, int, int, int, int]] = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                total = len(ids) // 4
                cuts = [0, *range(total % sequence or sequence, total + 1, sequence)]
                rows += [(doc, i, b, e - b, zlib.crc32(ids[4 * b:4 * e]))
                         for i, (b, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                                                strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.documents(docs).mapInArrow(run, PIECES)


def packed(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE,
           group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The ``pieces`` with sequence_id and offset.

    Nulls: a null text is an empty one, a piece with the end id alone; a null doc_id stays null.
    Repeated rows and ties are pieces of their own. Empty table: no rows. Other columns are
    ignored. Texts of any length are taken whole.
    """
    common.prepare(docs.sparkSession)
    cut = common.saved(pieces(docs, path, sequence).withColumn("at", F.monotonically_increasing_id()), "pieces")
    groups = common.partitions_for(cut.count(), group_pieces)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "at"], ascending=[False, True])
        number, offset = best_fit(group["length"].to_numpy(), sequence)
        return group.assign(sequence_id=group["g"] * (1 << 32) + number, offset=offset).drop(columns=["g", "at"])

    # doc_id may be null, which pandas would turn into a float: it goes along as text.
    dealt = cut.withColumn("g", F.pmod(F.xxhash64("at"), F.lit(groups))).withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = PIECES.replace("doc_id long", "doc_id string") + ", sequence_id long, offset long"
    return (dealt.groupBy("g").applyInPandas(pack, schema)
            .withColumn("doc_id", F.col("doc_id").cast("long")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(common.table(spark, sf_dir, "documents"))
