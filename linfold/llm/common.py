"""Shared helpers of the document operators: input columns, scratch tables, ship of the package."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python tasks: the workers must be able to import this package."""
    ship_package(spark)


def saved(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written below the shared folder of ``spark.checkpoint.dir`` and read again: it is
    computed once, and a lost executor loses nothing of it. ``codec``: the session's if None."""
    spark = df.sparkSession
    path = posixpath.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    return max(least, -(-rows // per_partition))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null: empty), nothing else but ``extra``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def keyed(docs: DataFrame, *carried: Column) -> DataFrame:
    """``_k`` long, doc_id, text and ``carried``: ``_k`` orders the rows as doc_id does (null last)
    and is unique.

    It is doc_id itself where that is unique and never null. Else the rows are numbered in the
    order of (doc_id, text); equal rows are interchangeable.
    """
    base = documents(docs, *carried)
    repeated = (base.groupBy("doc_id").count()
                .where((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).collect())
    if not repeated:
        return base.select(F.col("doc_id").alias("_k"), *base.columns)
    spark = base.sparkSession
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text")]
    ordered = saved(base.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                    .withColumn("_i", F.monotonically_increasing_id()), "keyed")
    part = F.shiftright("_i", 33)
    sizes = ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()   # a number per partition
    offset, total = {}, 0
    for row in sorted(sizes, key=lambda r: r.p):
        offset[row.p] = total
        total += row.n
    starts = spark.createDataFrame([*offset.items()] or [(0, 0)], "_p long, _o long")
    return (ordered.withColumn("_p", part).join(F.broadcast(starts), "_p")
            .select((F.col("_o") + F.col("_i").bitwiseAND((1 << 33) - 1)).alias("_k"), *base.columns))


def hex64(value: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
