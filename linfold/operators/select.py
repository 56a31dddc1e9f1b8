"""Exact order statistics of any number of rows and groups (medians, quantiles, k-th values).

Without groups: radix selection (``radix.py``), which shuffles counts only. With groups: values are
counted per (group, column), the counts are range-partitioned by (group, column, value), and the
counts of each partition's part of a column give the rank at which every part starts. Only the parts
that hold a wanted rank are then summed up row by row. A value that very many rows share is one
counted row; a group of any size is spread over the partitions, and the number of groups has no
bound; the driver gets nothing per group.
"""

from __future__ import annotations

import functools

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.exprs import nan_to_null, quote
from linfold.operators import radix
from linfold.session import materialize


class Ranked:
    """Counted values of ``columns`` (per group of ``by``) in range partitions, kept until
    ``release``. NULL and NaN are left out."""

    def __init__(self, df: DataFrame, columns: list[str], by: list[str] | None = None,
                 cast: str = "double"):
        self.columns, self.by = list(columns), list(by or [])
        self.groups = [f"g{i}" for i in range(len(self.by))]
        value = [F.col(quote(c)).cast(cast) for c in self.columns]
        if cast == "double":
            value = [nan_to_null(v) for v in value]
        stacked = df.select(
            *[F.col(quote(b)).alias(g) for b, g in zip(self.by, self.groups)],
            F.explode(F.array(*[F.struct(F.lit(i).alias("c"), v.alias("v"))
                                for i, v in enumerate(value)])).alias("e"))
        self.keys = [*self.groups, "c"]
        counted = (stacked.select(*self.groups, "e.c", "e.v").where("v IS NOT NULL")
                   .groupBy(*self.keys, "v").agg(F.count(F.lit(1)).alias("n")))
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        self.counted = (counted.repartitionByRange(parts, *self.keys, "v")
                        .withColumn("part", F.spark_partition_id())
                        .persist(StorageLevel.MEMORY_AND_DISK))

    def release(self) -> None:
        self.counted.unpersist()

    @staticmethod
    def match(keys: list[str], left: str = "a", right: str = "b") -> Column:
        """Equal keys (NULL equal to NULL) of two aliased sides."""
        return functools.reduce(lambda x, y: x & y,
                                [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])

    def at(self, low: Column, high: Column) -> DataFrame:
        """Per (group, column): the values at two 0-based ranks, which may use ``total``, with
        ``less`` and ``equal``, the rows below and at the low one."""
        part = self.counted.groupBy(*self.keys, "part").agg(F.sum("n").alias("rows"))
        ahead = W.partitionBy(*self.keys).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
        part = (part.withColumn("start", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
                .withColumn("total", F.sum("rows").over(W.partitionBy(*self.keys)))
                .withColumn("low", low).withColumn("high", high)
                .where("start <= high AND start + rows > low"))
        keys = [*self.keys, "part"]
        hit = self.counted.alias("a").join(part.alias("b"), self.match(keys))
        hit = hit.select(*[F.col(f"a.{k}").alias(k) for k in keys], "v", "n", "start", "low", "high", "total")
        inside = W.partitionBy(*keys).orderBy("v").rowsBetween(W.unboundedPreceding, -1)
        first = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
        hit = hit.withColumn("first", first)

        def holds(rank: str) -> Column:
            return (F.col("first") <= F.col(rank)) & (F.col(rank) < F.col("first") + F.col("n"))

        return hit.groupBy(*self.keys).agg(
            F.max(F.when(holds("low"), F.col("v"))).alias("v_low"),
            F.max(F.when(holds("high"), F.col("v"))).alias("v_high"),
            F.max(F.when(holds("low"), F.col("first"))).alias("less"),
            F.max(F.when(holds("low"), F.col("n"))).alias("equal"), F.max("total").alias("total"))

    def quantiles(self, q: float) -> DataFrame:
        """Per (group, column) the quantile ``q``, interpolated between the two nearest ranks."""
        if not 0.0 <= q <= 1.0:
            raise ValueError("q must lie between 0 and 1.")
        place = (F.col("total") - 1).cast("double") * F.lit(float(q))
        found = self.at(F.floor(place), F.ceil(place))
        share = place - F.floor(place)
        value = F.when(share == 0, F.col("v_low")).otherwise(
            F.col("v_low") + (F.col("v_high") - F.col("v_low")) * share)
        return found.select(*self.keys, value.alias("q"))


def exact_quantiles(df: DataFrame, columns: list[str], q: float = 0.5, by: list[str] | None = None):
    """The exact quantile of each column: a dict (None for a column without values), or with ``by``
    a DataFrame of one row per group (NULL is a group, too)."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must lie between 0 and 1.")
    if not by:
        return dict(zip(columns, radix.quantiles(df, list(columns), q), strict=True))
    ranked = Ranked(df, columns, by)
    try:
        wide = ranked.quantiles(q).groupBy(*ranked.groups).agg(
            *[F.max(F.when(F.col("c") == i, F.col("q"))).alias(c) for i, c in enumerate(columns)])
        groups = df.select(*[F.col(quote(b)).alias(g) for b, g in zip(by, ranked.groups)]).distinct()
        out = groups.alias("a").join(wide.alias("b"), ranked.match(ranked.groups), "left").select(
            *[F.col(f"a.{g}").alias(b) for b, g in zip(by, ranked.groups)], *[F.col(f"b.{quote(c)}") for c in columns])
        return materialize(out, "checkpoint")
    finally:
        ranked.release()


def kth_smallest_with_counts(df: DataFrame, column: str, k: int):
    """(value, rows below it, rows equal to it) for the 0-based rank ``k``; NULLs are left out."""
    kind = df.select(F.col(quote(column))).schema[0].dataType
    if not isinstance(kind, (T.IntegralType, T.FractionalType)):
        raise TypeError(f"column {column} must be numeric.")
    found = radix.select_ranks(df, [column], lambda total: [k], isinstance(kind, T.IntegralType))[0].get(k)
    if found is None:
        raise ValueError(f"rank {k} is outside the column's rows.")
    return found.value, found.less, found.equal


def kth_smallest(df: DataFrame, column: str, k: int):
    """The value at the 0-based rank ``k``."""
    return kth_smallest_with_counts(df, column, k)[0]
