"""Sources and sinks (S1-S4).

S1 ``load_table``: headed CSV (pandas-like typing) or Parquet/JSON; missing path -> clear error.
S2 ``save_processed_splits``: both prepared splits, features in order, target last; a
   directory per split (Parquet by default, CSV on request) -- never ``coalesce(1)``.
S3/S4 ``write_results``: result tables to CSV / JSON Lines with NaN written as NULL and
   every key kept.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.exprs import quote

# The strings pandas' CSV reader treats as missing by default.
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The strings pandas reads as booleans by default.
PANDAS_TRUE_VALUES = ("True", "TRUE", "true")
PANDAS_FALSE_VALUES = ("False", "FALSE", "false")


def _detect_format(spark: SparkSession, path: str) -> str:
    """By the path's ending, else by those of the files in the folder, which Spark's own file system
    client lists (the driver's disk may hold nothing of it)."""
    known = ("parquet", "csv", "json", "orc")
    names = [path.rstrip("/").lower()]
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path(path)
        names += [f.getPath().getName().lower() for f in place.getFileSystem(conf).listStatus(place)]
    except Exception:  # noqa: BLE001 -- no such path (the reader will say so), or a Connect session
        pass
    for name in names:
        parts = name.rsplit("/", 1)[-1].split(".")[1:]
        found = [ext for ext in known if ext in parts]
        if found:
            return found[0]
    return "csv"


def _na_to_null(raw: DataFrame, na_values: tuple[str, ...]) -> DataFrame:
    return raw.select(*[F.when(F.col(quote(c)).isin(list(na_values)), F.lit(None).cast("string"))
                        .otherwise(F.col(quote(c))).alias(c) for c in raw.columns])


def _type_csv_columns(raw: DataFrame, na_values: tuple[str, ...]) -> DataFrame:
    """Map NA tokens to NULL, then type every column like pandas would: integer if every
    value parses as one (and none is missing), else float if every value parses, boolean
    for True/False tokens, otherwise string. One aggregate pass decides all columns."""
    cleaned = _na_to_null(raw, na_values)
    bools = list(PANDAS_TRUE_VALUES + PANDAS_FALSE_VALUES)
    aggs = []
    for i, c in enumerate(cleaned.columns):
        v = F.col(quote(c))
        aggs += [F.count(F.lit(1)).alias(f"rows{i}") if i == 0 else F.lit(0).alias(f"rows{i}"),
                 F.count(v).alias(f"n{i}"),
                 F.count(F.expr(f"try_cast({quote(c)} AS BIGINT)")).alias(f"int{i}"),
                 F.count(F.expr(f"try_cast({quote(c)} AS DOUBLE)")).alias(f"dbl{i}"),
                 F.count(F.when(v.isin(bools), 1)).alias(f"bool{i}")]
    row = cleaned.agg(*aggs).collect()[0]
    total = row["rows0"]
    exprs = []
    for i, c in enumerate(cleaned.columns):
        n = row[f"n{i}"]
        v = F.col(quote(c))
        if n == 0:
            exprs.append(v.cast("double").alias(c))
        elif row[f"int{i}"] == n and n == total:
            exprs.append(F.expr(f"try_cast({quote(c)} AS BIGINT)").alias(c))
        elif row[f"dbl{i}"] == n:
            exprs.append(F.expr(f"try_cast({quote(c)} AS DOUBLE)").alias(c))
        elif row[f"bool{i}"] == n and n == total:
            exprs.append(v.isin(list(PANDAS_TRUE_VALUES)).alias(c))
        else:
            exprs.append(v.alias(c))
    return cleaned.select(*exprs)


# The CSV dialect of pandas (quotes doubled inside quotes, white space kept).
CSV_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}


def load_table(spark: SparkSession, path: str, fmt: str | None = None,
               schema: T.StructType | str | None = None,
               na_values: tuple[str, ...] = PANDAS_NA_VALUES, multi_line: bool = False) -> DataFrame:
    """Read a table. CSV needs a header; NA tokens become NULL, and without a schema the columns are
    typed as pandas would type them. With a schema (by position) a value that does not fit its type
    is an error. ``multi_line``: quoted values may hold line ends; a file is then read by one task."""
    fmt = fmt or _detect_format(spark, path)
    try:
        if fmt == "csv":
            raw = (spark.read.options(header=True, mode="FAILFAST", inferSchema=False, multiLine=multi_line,
                                      **CSV_DIALECT).csv(path))
            if schema is None:
                return _type_csv_columns(raw, na_values)
            wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            if len(wanted) != len(raw.columns):
                raise ValueError(f"The schema has {len(wanted)} columns, the file {len(raw.columns)}.")
            clean = _na_to_null(raw, na_values)
            return clean.select(*[F.col(quote(c)).cast(f.dataType).alias(f.name)
                                  for c, f in zip(raw.columns, wanted)])
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.format(fmt).load(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"Input file not found: {path}. Pass a valid data path.") from exc
        raise


def _nan_to_null_all(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(quote(f.name))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(header=True, **CSV_DIALECT).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.format(fmt).save(path)
    return path


def write_results(results: DataFrame, path: str, fmt: str = "csv") -> str:
    """S3 (CSV) / S4 (JSON Lines): NaN becomes an empty field / ``null``; keys always kept."""
    return write_table(_nan_to_null_all(results), path, fmt)


SPLITS_MANIFEST = "splits_manifest"
MANIFEST_SCHEMA = "split string, row_count long, complete boolean"


def save_processed_splits(prepared, output_dir: str, fmt: str = "parquet",
                          train_name: str = "train_processed",
                          test_name: str = "test_processed") -> tuple[str, str]:
    """Write both prepared splits: feature columns in order, then the (scaled) target.

    The two belong together: a manifest beside them says that they are being written, and after
    both are, how many rows each has. ``load_processed_splits`` refuses a pair without it."""
    spark = prepared.train.sparkSession
    cols = [quote(c) for c in prepared.feature_names] + [quote(prepared.target_column)]
    paths = {name: os.path.join(output_dir, name) for name in (train_name, test_name)}

    def manifest(rows: list[tuple]) -> None:
        write_table(spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1),
                    os.path.join(output_dir, SPLITS_MANIFEST), "json")

    manifest([(name, None, False) for name in paths])
    for (name, path), split in zip(paths.items(), (prepared.train, prepared.test), strict=True):
        write_table(split.select(*cols), path, fmt)
    manifest([(name, _written_rows(spark, path, fmt), True) for name, path in paths.items()])
    return paths[train_name], paths[test_name]


def _written_rows(spark: SparkSession, path: str, fmt: str) -> int:
    reader = spark.read.option("header", True).option("multiLine", True) if fmt == "csv" else spark.read
    return reader.format(fmt).load(path).count()


def load_processed_splits(spark: SparkSession, output_dir: str, fmt: str = "parquet",
                          train_name: str = "train_processed",
                          test_name: str = "test_processed") -> tuple[DataFrame, DataFrame]:
    """Both splits of ``save_processed_splits``; an error if they were not written to the end
    together or hold other numbers of rows."""
    path = os.path.join(output_dir, SPLITS_MANIFEST)
    try:
        rows = {r["split"]: r for r in spark.read.schema(MANIFEST_SCHEMA).json(path).collect()}
    except AnalysisException:
        rows = {}
    out = []
    for name in (train_name, test_name):
        row = rows.get(name)
        if row is None or not row["complete"]:
            raise ValueError(f"{name} in {output_dir} is not part of a complete pair of splits.")
        split = os.path.join(output_dir, name)
        found = _written_rows(spark, split, fmt)
        if found != row["row_count"]:
            raise ValueError(f"{name} in {output_dir} holds {found} rows, not {row['row_count']}.")
        out.append(load_table(spark, split, fmt))
    return out[0], out[1]
