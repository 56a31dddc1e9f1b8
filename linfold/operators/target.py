"""Target extraction (P1) and column typing (P2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.exprs import quote

# Fixed value: the reference's default target scale (target expressed in 100 000 units).
TARGET_SCALE = 100_000.0


def split_target(df: DataFrame, target_column: str, target_scale: float = TARGET_SCALE,
                 id_columns: list[str] | tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """Validate the target, scale it, and name the feature columns.

    Returns ``(frame, features)``: ``frame`` keeps the id columns, every feature column and
    the target (cast to double and divided by ``target_scale``) under its own name, last.
    """
    if target_column not in df.columns:
        raise ValueError(f"Target column not found: {target_column}. "
                         f"Available columns: {', '.join(df.columns)}")
    if target_scale <= 0:
        raise ValueError("target_scale must be positive.")
    ids = list(id_columns)
    features = [c for c in df.columns if c != target_column and c not in ids]
    frame = df.select(*[quote(c) for c in ids], *[quote(c) for c in features],
                      (F.col(quote(target_column)).cast("double") / F.lit(float(target_scale)))
                      .alias(target_column))
    return frame, features


def check_targets(train: DataFrame, test: DataFrame, target_column: str) -> None:
    """Both splits hold rows, and every row has a finite target."""
    y = F.col(quote(target_column))
    odd = y.isNull() | F.isnan(y) | (F.abs(y) == F.lit(float("inf")))
    for name, frame in (("train", train), ("test", test)):
        row = frame.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("bad")).first()
        if row["n"] == 0:
            raise ValueError(f"The {name} split is empty; use another test_size, key or split mode.")
        if row["bad"]:
            raise ValueError(f"{row['bad']} rows of the {name} split have a NULL, NaN or infinite target.")


def feature_types(schema: T.StructType, features: list[str]) -> tuple[list[str], list[str]]:
    """Numeric columns (any Spark numeric type) and categorical ones (everything else,
    booleans and dates included), each in source column order."""
    if not features:
        raise ValueError("At least one feature column is required for preprocessing.")
    numeric, categorical = [], []
    for name in features:
        dtype = schema[name].dataType
        (numeric if isinstance(dtype, T.NumericType) else categorical).append(name)
    return numeric, categorical
