"""Leakage-safe preprocessing (E1-E6): fitted on train only, applied to any table.

Numeric branch: median imputation -> standard scaling (population std).
Categorical branch: most-frequent imputation -> one-hot, one column per train category,
unseen categories map to all zeros. Numeric block first, then categorical; every other
column is dropped unless passed through explicitly.

Fit cost: one aggregate pass for counts/mean/variance of the numeric columns, the exact medians
(counted values in range partitions, see ``select.py``; the median-filled mean/std follow by exact pooling), and one stacked
``groupBy(column, value)`` for modes and category lists. Only per-column statistics reach
the driver. Transform is a single
narrow ``select`` -- no shuffle, fused into whole-stage codegen.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.exprs import nan_to_null, quote
from linfold.operators.select import exact_quantiles
from linfold.operators.target import feature_types

_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class PreprocessorModel:
    numeric: tuple[str, ...]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    categorical: tuple[str, ...]
    modes: dict[str, str]
    categories: dict[str, tuple[str, ...]]
    dropped: tuple[str, ...] = field(default_factory=tuple)

    @functools.cached_property
    def feature_names(self) -> list[str]:
        """Numeric columns, then ``column_value`` per category. Spark does not tell names apart by
        case, so a name that an earlier one already has gets a number (``c_a``, ``c_A__2``)."""
        names = [*self.numeric, *[f"{c}_{v}" for c in self.categorical for v in self.categories[c]]]
        seen: set[str] = set()
        out = []
        for name in names:
            new, number = name, 2
            while new.lower() in seen:
                new, number = f"{name}__{number}", number + 1
            seen.add(new.lower())
            out.append(new)
        return out

    @functools.cached_property
    def positions(self) -> dict[tuple[str, str], int]:
        """Index in ``feature_names`` of each (column, category)."""
        pairs = [(c, v) for c in self.categorical for v in self.categories[c]]
        return {pair: len(self.numeric) + i for i, pair in enumerate(pairs)}

    def numeric_expr(self, c: str) -> Column:
        filled = F.coalesce(nan_to_null(F.col(quote(c)).cast("double")), F.lit(self.medians[c]))
        return (filled - F.lit(self.means[c])) / F.lit(self.scales[c])

    def category_exprs(self, c: str, dtype: T.DataType | None = None) -> list[Column]:
        raw = category_value(c, dtype) if dtype is not None else F.col(quote(c)).cast("string")
        value = F.coalesce(raw, F.lit(self.modes[c]))
        names = self.feature_names
        return [F.when(value == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(names[self.positions[c, v]])
                for v in self.categories[c]]

    def filled_category(self, c: str, dtype: T.DataType) -> Column:
        return F.coalesce(category_value(c, dtype), F.lit(self.modes[c]))

    def prediction_column(self, weights, schema: T.StructType) -> Column:
        """``w0 + sum_j w_j u_j + sum_c W_c[value_c]`` straight from the raw columns: one map
        lookup per categorical column instead of one term per category (an unseen
        category adds 0, as its all-zero one-hot row would)."""
        w = np.asarray(weights, dtype=float).reshape(-1)
        names = self.feature_names
        if w.shape[0] != len(names) + 1:
            raise ValueError("weights length must equal the number of features plus the intercept.")
        expr: Column = F.lit(float(w[0]))
        for j, c in enumerate(self.numeric):
            expr = expr + F.lit(float(w[j + 1])) * self.numeric_expr(c)
        pos = 1 + len(self.numeric)
        for c in self.categorical:
            cats = self.categories[c]
            table = F.create_map(*[x for v, wt in zip(cats, w[pos:pos + len(cats)])
                                   for x in (F.lit(v), F.lit(float(wt)))])
            expr = expr + F.coalesce(F.try_element_at(table, self.filled_category(
                c, schema[c].dataType)), F.lit(0.0))
            pos += len(cats)
        return expr

    def transform_vector(self, df: DataFrame, passthrough: list[str] | tuple[str, ...] = (),
                         output: str = "features") -> DataFrame:
        """The same features as one ML vector column (sparse one-hot blocks), for very
        high-cardinality columns and for Spark ML consumers. Spark ML built-ins: a
        ``StringIndexerModel`` over the train categories (``handleInvalid="keep"``) and a
        ``OneHotEncoder`` with ``dropLast=True`` -- the dropped slot is the "unseen" one,
        so an unseen category encodes as all zeros, as in the wide form."""
        from pyspark.ml import PipelineModel
        from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler

        base = df.select(*[self.numeric_expr(c).alias(f"_n{j}") for j, c in enumerate(self.numeric)],
                         *[self.filled_category(c, df.schema[c].dataType).alias(f"_c{i}")
                           for i, c in enumerate(self.categorical)],
                         *[F.col(quote(p)) for p in passthrough])
        stages = [StringIndexerModel.from_labels(list(self.categories[c]), inputCol=f"_c{i}",
                                                 outputCol=f"_i{i}", handleInvalid="keep")
                  for i, c in enumerate(self.categorical)]
        indexed = PipelineModel(stages).transform(base) if stages else base
        cols = [f"_n{j}" for j in range(len(self.numeric))]
        if self.categorical:
            encoder = OneHotEncoder(inputCols=[f"_i{i}" for i in range(len(self.categorical))],
                                    outputCols=[f"_o{i}" for i in range(len(self.categorical))],
                                    dropLast=True).fit(indexed)
            indexed = encoder.transform(indexed)
            cols += [f"_o{i}" for i in range(len(self.categorical))]
        out = VectorAssembler(inputCols=cols, outputCol=output).transform(indexed)
        return out.select(output, *[quote(p) for p in passthrough])

    def transform(self, df: DataFrame, passthrough: list[str] | tuple[str, ...] = ()) -> DataFrame:
        """Feature columns in order, then the passthrough columns (ids, target)."""
        names = self.feature_names
        exprs: list[Column] = [self.numeric_expr(c).alias(c) for c in self.numeric]
        for c in self.categorical:
            exprs += self.category_exprs(c, df.schema[c].dataType)
        out = df.select(*exprs, *[quote(p) for p in passthrough])
        assert out.columns[:len(names)] == names
        return out


def category_table(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column, category, n): the categories of each column in ``train`` as a table, which may be
    of any size (NULL is no category)."""
    return (_stacked(train, columns).where("category IS NOT NULL")
            .groupBy("column", "category").agg(F.count(F.lit(1)).alias("n")))


def onehot_long(df: DataFrame, columns: list[str], table: DataFrame, keep: list[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows (``keep``, column, category), by a join with a
    ``category_table``: the form for columns with too many categories for a column each. A value
    that the table does not have, or NULL, has no row."""
    return (_stacked(df, columns, keep).join(table.select("column", "category"), ["column", "category"], "left_semi")
            .select(*[F.col(quote(k)) for k in keep], "column", "category"))


def _stacked(df: DataFrame, columns: list[str], keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(quote(k)) for k in keep], F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), category_value(c, df.schema[c].dataType).alias("category"))
        for c in columns])).alias("e")).select(*[F.col(quote(k)) for k in keep], "e.column", "e.category")


def category_value(c: str, dtype: T.DataType) -> Column:
    """A categorical column as strings; booleans spelled as pandas prints them."""
    col = F.col(quote(c))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    return col.cast("string")


def _is_constant(var: float, mean: float, n: int) -> bool:
    # a numerically constant column is scaled by 1, like a zero-variance one
    upper = n * _EPS * var + (n * mean * _EPS) ** 2
    return var <= upper


class Preprocessor:
    """``Preprocessor(features).fit(train) -> PreprocessorModel``."""

    def __init__(self, features: list[str] | None = None, max_categories: int | None = None,
                 median: str = "exact", median_accuracy: int = 10_000):
        """``max_categories`` (none by default) makes the fit fail where a column has more.
        ``median="approx"`` trades the exact median for one ``percentile_approx`` pass
        (relative rank error 1 / ``median_accuracy``) on very large inputs."""
        if median not in ("exact", "approx"):
            raise ValueError("median must be 'exact' or 'approx'.")
        self.features = features
        self.max_categories = max_categories
        self.median = median
        self.median_accuracy = median_accuracy

    def fit(self, train: DataFrame) -> PreprocessorModel:
        features = list(self.features) if self.features is not None else list(train.columns)
        numeric, categorical = feature_types(train.schema, features)
        dropped: list[str] = []

        medians: dict[str, float] = {}
        means: dict[str, float] = {}
        scales: dict[str, float] = {}
        # one pass: counts, mean and variance of the numeric columns
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(numeric):
            x = nan_to_null(F.col(quote(c)).cast("double"))
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
        row = train.agg(*aggs).collect()[0]
        total = row["rows"]
        if total == 0:
            raise ValueError("At least one training row is required for preprocessing.")
        if numeric:
            # the exact medians reuse the counts; the statistics of the median-filled column
            # follow exactly from pooling the values with their NULLs set to the median
            present = [c for i, c in enumerate(numeric) if row[f"n{i}"]]
            dropped += [c for c in numeric if c not in present]
            stats = {c: (row[f"n{i}"], row[f"m{i}"], row[f"v{i}"])
                     for i, c in enumerate(numeric) if c in present}
            if self.median == "approx" and present:
                r = train.agg(*[F.percentile_approx(nan_to_null(F.col(quote(c)).cast("double")),
                                                    0.5, self.median_accuracy).alias(c)
                                for c in present]).collect()[0]
                med = {c: r[c] for c in present}
            else:
                med = exact_quantiles(train, present, 0.5) if present else {}
            for c in present:
                m, mu, var = stats[c]
                medians[c] = float(med[c])
                fill = total - m
                mean = (m * mu + fill * medians[c]) / total if fill else float(mu)
                if fill:
                    var = (m * var + m * (mu - mean) ** 2
                           + fill * (medians[c] - mean) ** 2) / total
                means[c] = float(mean)
                scales[c] = 1.0 if _is_constant(float(var), mean, total) else float(np.sqrt(var))
            numeric = present

        modes: dict[str, str] = {}
        categories: dict[str, tuple[str, ...]] = {}
        if categorical:
            stacked = train.select(F.explode(F.array(*[
                F.struct(F.lit(i).alias("c"), category_value(c, train.schema[c].dataType).alias("v"))
                for i, c in enumerate(categorical)])).alias("e")).filter(F.col("e.v").isNotNull())
            # the categories are the model (one weight each), so they come to the driver
            rows = (stacked.groupBy(F.col("e.c").alias("c"), F.col("e.v").alias("v")).count().collect())
            per_col: dict[int, list[tuple[str, int]]] = {}
            for r in rows:
                per_col.setdefault(r["c"], []).append((r["v"], r["count"]))
            kept_cat = []
            for i, c in enumerate(categorical):
                pairs = per_col.get(i, [])
                if not pairs:
                    dropped.append(c)
                    continue
                if self.max_categories is not None and len(pairs) > self.max_categories:
                    raise ValueError(f"Column {c} has more than {self.max_categories} categories.")
                kept_cat.append(c)
                categories[c] = tuple(sorted(v for v, _ in pairs))
                top = max(cnt for _, cnt in pairs)
                modes[c] = min(v for v, cnt in pairs if cnt == top)
            categorical = kept_cat

        if not numeric and not categorical:
            raise ValueError("No usable feature column: all are empty in the training data.")
        return PreprocessorModel(tuple(numeric), medians, means, scales, tuple(categorical),
                                 modes, categories, tuple(dropped))


def build_preprocessor(features: list[str], max_categories: int | None = None) -> Preprocessor:
    return Preprocessor(features, max_categories)
