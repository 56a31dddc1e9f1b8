"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)


def _as_col(c: str | Column) -> Column:
    return F.col(quote(c)) if isinstance(c, str) else c


def quote(name: str) -> str:
    """Back-quote a column name so dots, spaces and ``<`` resolve literally."""
    return "`" + name.replace("`", "``") + "`"


HASH_ALGORITHMS = ("md5", "xxhash64")


def hash52(seed: int | str, *keys: str | Column, algorithm: str = "md5") -> Column:
    """A 52-bit hash of ``seed`` and the key values as a bigint in [0, 2^52).

    Depends only on the key values, never on partitioning, and is exactly representable
    as a double. ``md5`` (default) takes the first 52 bits of ``md5('<seed>:<k1>:...')``;
    the same number comes out of DuckDB with
    ``('0x' || substr(md5(concat_ws(':', seed, key)), 1, 13))::BIGINT``. ``xxhash64`` is
    Spark's built-in 64-bit hash reduced mod 2^52: about ten times cheaper per row, for
    when cross-engine reproducibility of the membership is not needed.
    """
    columns = [_as_col(k) for k in keys]
    if algorithm == "xxhash64":   # the hash passes over NULLs, so their places go in with them
        places = [c.isNull() for c in columns]
        return F.pmod(F.xxhash64(F.lit(str(seed)), *columns, *places), F.lit(2 ** 52)).cast("bigint")
    if algorithm != "md5":
        raise ValueError(f"algorithm must be one of {HASH_ALGORITHMS}.")
    parts = [F.lit(str(seed))] + [F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def hash_unit(seed: int | str, *keys: str | Column) -> Column:
    """A uniform number in the open interval (0, 1) derived from ``hash52``."""
    return (hash52(seed, *keys).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_52)


def hash_normal(seed: int | str, *keys: str | Column) -> Column:
    """A standard normal number by Box-Muller from two hash uniforms (layout independent)."""
    u1 = hash_unit(seed, *keys, F.lit("u"))
    u2 = hash_unit(seed, *keys, F.lit("v"))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def nan_to_null(c: str | Column) -> Column:
    col = _as_col(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def linear_combination(intercept: float, weights: Sequence[float],
                       columns: Sequence[str | Column]) -> Column:
    """``w0 + w1*x1 + ... + wd*xd`` with driver literals, summed left to right."""
    if len(weights) != len(columns):
        raise ValueError("weights length must equal the number of feature columns (plus intercept).")
    expr: Column = F.lit(float(intercept))
    for w, c in zip(weights, columns):
        expr = expr + F.lit(float(w)) * _as_col(c).cast("double")
    return expr


# Absolute noise floor of the comparison rounding: magnitudes below it are round-off of
# sums whose true value is zero (e.g. a coefficient of an exactly collinear feature).
NOISE_FLOOR = 1e-12


def round_sig(c: str | Column, digits: int = 6) -> Column:
    """Round to ``digits`` significant decimal digits (engine-independent value hashes)."""
    col = _as_col(c).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(col))))
    return (F.when(F.abs(col) < F.lit(NOISE_FLOOR), F.lit(0.0))
            .when(F.isnan(col) | F.abs(col).isin(float("inf")), col)
            .otherwise(F.round(col * scale) / scale))


def round_sig_sql(expr: str, digits: int = 6) -> str:
    """The SQL text of ``round_sig`` for the DuckDB oracle."""
    e = f"({expr})"
    scale = f"pow(10.0, {float(digits - 1)} - floor(log10(abs({e}))))"
    return (f"(CASE WHEN abs({e}) < CAST({NOISE_FLOOR!r} AS DOUBLE) THEN CAST(0.0 AS DOUBLE) "
            f"ELSE round({e} * {scale}) / {scale} END)")


def word_count(c: str | Column) -> Column:
    """Number of whitespace-separated tokens of a text column (whole text); a regex match
    count, so it stays inside whole-stage codegen (no lambda)."""
    return F.regexp_count(_as_col(c), F.lit(r"\S+")).cast("double")


def word_count_sql(expr: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({expr}, '\\s+'), lambda t: t <> '')) AS DOUBLE)"


def line_count(c: str | Column) -> Column:
    """Number of lines (newline-separated pieces) of a text column."""
    return F.size(F.split(_as_col(c), "\n", -1)).cast("double")


def line_count_sql(expr: str) -> str:
    return f"CAST(len(string_split({expr}, chr(10))) AS DOUBLE)"
