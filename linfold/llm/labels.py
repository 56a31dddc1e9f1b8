"""Labels and folds for the learned operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000   # bound of a training sample (labelled rows); a parameter of each operator


def fold(modulus: int) -> Column:
    """crc32 of doc_id written as text, modulo ``modulus`` (a null doc_id: of the empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def known(labels: DataFrame, label: str, keep: Column | None = None) -> DataFrame:
    """doc_id, label of every labelled document. Rows without doc_id or label are left out; of several
    labels for a doc_id the smallest counts."""
    found = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IS NOT NULL"))
    if keep is not None:
        found = found.where(keep)
    return found.groupBy("doc_id").agg(F.min("label").alias("label"))


def sample(labels: DataFrame, label: str, rows: int, keep: Column | None = None) -> DataFrame:
    """``known``: ``rows`` documents at most, those with the smallest hash of doc_id."""
    return known(labels, label, keep).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
