"""Categorical columns whose categories stay a table (E3-E5, G1, B1/B2, G9 for very many categories).

``CategoryModel.fit`` learns medians, scales and modes (one row per *column* reaches the driver) and
keeps the categories as a DataFrame (c, category, n, id): a one-hot design without a column, a
literal or a driver object per category. ``transform`` gives the ones of the design as rows;
``predict`` adds the weights of the categories by joins. An unseen category has no row and adds 0.

``NormalEquations`` holds the centred normal matrix of that design as rows: per category its count
and the sums of the numeric columns, per pair of categories of different columns how often they meet.
``solve`` finds least-squares or ridge weights by conjugate gradients. The vectors are columns of the
table of categories; a product joins them to the pairs, and the driver gets one row of sums per pass.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.gram import gram_stats
from linfold.operators.preprocess import Preprocessor, PreprocessorModel, category_value
from linfold.operators.target import feature_types
from linfold.session import materialize

BROADCAST_BYTES = 8 << 20    # a column's categories up to this measured size are sent to every task
SALTS = 16                   # beyond it, rows of a hot category are dealt over so many tasks
LINEAGE = 8                  # iterations without pairs after which the vectors go to the shared folder


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``id``, 0 .. n - 1 in the order of the columns ``order``, kept in the shared
    folder. The driver gets one number per partition."""
    parts = _partitions(df)
    placed = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("_i", F.monotonically_increasing_id()), "checkpoint")
    part = F.shiftright("_i", 33).cast("int")
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    start, starts = 0, [0] * (max(sizes, default=0) + 1)
    for p in sorted(sizes):
        starts[p], start = start, start + sizes[p]
    offset = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), part + 1)
    return placed.withColumn("id", offset + F.col("_i").bitwiseAND((1 << 33) - 1)).drop("_i")


@dataclass(frozen=True)
class CategoryModel:
    numeric: PreprocessorModel | None      # medians, means and scales of the numeric columns
    columns: tuple[str, ...]               # categorical columns
    modes: dict[str, str]
    sizes: dict[str, int]                  # categories per column
    bytes: dict[str, int]                  # measured size of a column's categories
    hot: dict[str, tuple[str, ...]]        # categories with very many rows (a bounded list)
    rows: int
    table: DataFrame                       # c int, category string, n long, id long

    @property
    def numeric_names(self) -> tuple[str, ...]:
        return self.numeric.numeric if self.numeric else ()

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    @classmethod
    def fit(cls, train: DataFrame, features: list[str]) -> CategoryModel:
        """Statistics of ``train``: medians and scales, modes (ties: the smallest), categories with
        their rows after the modes have filled the NULLs. A column without any value is left out."""
        numeric, categorical = feature_types(train.schema, list(features))
        part = Preprocessor(numeric).fit(train) if numeric else None
        rows = train.count()
        if rows == 0:
            raise ValueError("At least one training row is required for preprocessing.")
        counts = (train.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("c"), category_value(c, train.schema[c].dataType).alias("category"))
            for i, c in enumerate(categorical)])).alias("e")).select("e.*")
            .groupBy("c", "category").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
            ) if categorical else train.sparkSession.createDataFrame([], "c int, category string, n long")
        try:
            found = (counts.where("category IS NOT NULL").groupBy("c")
                     .agg(F.min_by("category", F.struct((-F.col("n")).alias("n"), "category")).alias("mode"),
                          F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("category") + F.lit(32)).alias("bytes"))
                     .collect())   # one row per column
            per = {categorical[r["c"]]: r for r in found}
            modes = {c: r["mode"] for c, r in per.items()}
            mode = F.coalesce(*[F.when(F.col("c") == r["c"], F.lit(r["mode"])) for r in per.values()],
                              F.lit(None).cast("string"))
            filled = (counts.withColumn("category", F.coalesce("category", mode)).where("category IS NOT NULL")
                      .groupBy("c", "category").agg(F.sum("n").alias("n")))
            table = numbered(filled, ["c", "category"])
        finally:
            counts.unpersist()
        most = 4 * _partitions(train)
        hot = table.where(F.col("n") * most > rows).select("c", "category").collect()   # fewer than ``most`` a column
        names = tuple(c for c in categorical if c in per)
        return cls(part, names, modes, {c: per[c]["size"] for c in names}, {c: per[c]["bytes"] or 0 for c in names},
                   {c: tuple(h["category"] for h in hot if categorical[h["c"]] == c) for c in names}, rows,
                   table.withColumn("c", _renumbered([categorical.index(c) for c in names])))

    def value(self, c: str, df: DataFrame) -> Column:
        return F.coalesce(category_value(c, df.schema[c].dataType), F.lit(self.modes[c]))

    def transform(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The ones of the categorical block as rows: ``keep``, column, category, id (position among
        all categories in the order of column and category). Values not in the table have no row."""
        out = None
        for i, c in enumerate(self.columns):
            base = df.select(*[F.col(quote(k)) for k in keep], self.value(c, df).alias("_value"))
            part = (self._joined(base, "_value", c, self.table.select("c", "category", "id"), ["id"], "inner")
                    .select(*[F.col(quote(k)) for k in keep], F.lit(c).alias("column"),
                            F.col("_value").alias("category"), "id"))
            out = part if out is None else out.union(part)
        if out is None:
            raise ValueError("the model has no categorical column")
        return out

    def _joined(self, df: DataFrame, value: str, c: str, table: DataFrame, payload: list[str], how: str) -> DataFrame:
        """``df`` with ``payload`` of the row of ``table`` for the category in ``value``."""
        own = table.where(F.col("c") == self.columns.index(c)).select(
            F.col("category").alias("_category"), *payload)
        if self.bytes[c] <= BROADCAST_BYTES:
            return df.join(F.broadcast(own), F.col(value) == F.col("_category"), how).drop("_category")
        is_hot = F.col(value).isin(*self.hot[c]) if self.hot[c] else F.lit(False)
        # Any salt meets the same row, so it does not matter which one a row gets.
        left = df.withColumn("_salt", F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
                             .otherwise(F.lit(0)).cast("int"))
        spread = F.col("_category").isin(*self.hot[c]) if self.hot[c] else F.lit(False)
        right = own.withColumn("_salt2", F.explode(F.when(spread, F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                                   .otherwise(F.array(F.lit(0)))))
        match = (F.col(value) == F.col("_category")) & (F.col("_salt") == F.col("_salt2"))
        return left.join(right, match, how).drop("_category", "_salt", "_salt2")

    def predict(self, df: DataFrame, weights: CategoryWeights, output: str = "prediction") -> DataFrame:
        """``df`` plus the prediction: numeric part as an expression, categories by a join each."""
        kept = df.columns
        expr: Column = F.lit(weights.intercept)
        for w, c in zip(weights.numeric, self.numeric_names, strict=True):
            expr = expr + F.lit(float(w)) * self.numeric.numeric_expr(c)
        out = df.withColumn("_sum", expr)
        for i, c in enumerate(self.columns):
            table = weights.table.select("c", "category", F.col("weight").alias("_w"))
            out = self._joined(out.withColumn("_value", self.value(c, df)), "_value", c, table, ["_w"], "left")
            out = out.withColumn("_sum", F.col("_sum") + F.coalesce("_w", F.lit(0.0))).drop("_w", "_value")
        return out.select(*[F.col(quote(k)) for k in kept], F.col("_sum").alias(output))


def _renumbered(order: list[int]) -> Column:
    """Column numbers after columns without values are gone."""
    return F.coalesce(*[F.when(F.col("c") == old, F.lit(new)) for new, old in enumerate(order)],
                      F.lit(None).cast("int"))


@dataclass(frozen=True)
class CategoryWeights:
    intercept: float
    numeric: np.ndarray
    table: DataFrame        # c, category, n, id, weight
    iterations: int


class NormalEquations:
    """Centred normal equations of [numeric, one-hot] and ``target`` over ``raw``, kept until
    ``release``. Rows with a NULL, NaN or infinite target are an error."""

    def __init__(self, raw: DataFrame, model: CategoryModel, target: str):
        self.model, self.spark = model, raw.sparkSession
        numeric = model.numeric_names
        u = [f"_u{j}" for j in range(len(numeric))]
        frame = raw.select(*[model.numeric.numeric_expr(c).alias(a) for c, a in zip(numeric, u, strict=True)],
                           *[model.value(c, raw).alias(f"_c{i}") for i, c in enumerate(model.columns)],
                           F.col(quote(target)).cast("double").alias("_y"))
        base = gram_stats(frame, u, "_y")
        self.n, self.m, self.size = base.n, len(numeric), model.size
        self.mean_y, self.mean_u, self.cuu, self.cuy = base.mean_y, base.mean_x, base.cxx, base.cxy
        parts = _partitions(raw)
        # Per category: rows, sums of the numeric columns and of the target.
        single = (frame.select(*u, "_y", F.explode(F.array(*[
            F.struct(F.lit(i).alias("c"), F.col(f"_c{i}").alias("category")) for i in range(len(model.columns))])).alias("e"))
            .groupBy("e.c", "e.category").agg(F.count(F.lit(1)).cast("double").alias("cnt"), F.sum("_y").alias("_y"),
                                              *[F.sum(x).alias(x) for x in u]))
        self.table = (model.table.select("c", "category", "n", "id").join(single, ["c", "category"], "left")
                      .na.fill(0.0, ["cnt", "_y", *u])
                      .select("c", "category", "n", "id", "cnt", *u, (F.col("_y") - F.col("cnt") * F.lit(self.mean_y)).alias("right"))
                      .repartition(parts, "id").persist(StorageLevel.MEMORY_AND_DISK))
        self.sums = u
        pairs = [(a, b) for a in range(len(model.columns)) for b in range(a + 1, len(model.columns))]
        self.hot, self.pairs = [], []
        if pairs:
            ids = model.table.select("c", "category", "id")
            both = (frame.select(F.explode(F.array(*[
                F.struct(F.lit(a).alias("a"), F.col(f"_c{a}").alias("v"), F.lit(b).alias("b"), F.col(f"_c{b}").alias("w"))
                for a, b in pairs])).alias("e")).select("e.*")
                .groupBy("a", "v", "b", "w").agg(F.count(F.lit(1)).cast("double").alias("met")))
            both = (both.join(ids.toDF("a", "v", "i"), ["a", "v"]).join(ids.toDF("b", "w", "j"), ["b", "w"])
                    .select("i", "j", "met"))
            both = both.union(both.select(F.col("j").alias("i"), F.col("i").alias("j"), "met"))
            # Categories with very many rows meet very many others: they are sent to the pairs.
            self.hot = [r["id"] for r in self.table.where(F.col("cnt") * (4 * parts) > self.n).select("id").collect()]
            self.pairs = [p.persist(StorageLevel.MEMORY_AND_DISK) for p in (
                both.where(F.col("j").isin(self.hot)).repartition(parts, "i"),
                both.where(~F.col("j").isin(self.hot)).repartition(parts, "j"))]

    def release(self) -> None:
        for df in (self.table, *self.pairs):
            df.unpersist()

    def _product(self, table: DataFrame, numeric: np.ndarray) -> DataFrame:
        """``table`` with ``_a``: the categories' rows of the matrix, not centred, times the vector of
        ``numeric`` and column ``p``."""
        own = F.col("cnt") * F.col("p")
        for x, v in zip(self.sums, numeric, strict=True):
            own = own + F.col(x) * F.lit(float(v))
        if not self.pairs:
            return table.withColumn("_a", own)
        vector = table.select(F.col("id").alias("j"), "p")
        hot, others = self.pairs
        met = (hot.join(F.broadcast(vector.where(F.col("j").isin(self.hot))), "j").select("i", "met", "p")
               .union(others.join(vector, "j").select("i", "met", "p"))
               .groupBy(F.col("i").alias("id")).agg(F.sum(F.col("met") * F.col("p")).alias("_b")))
        return table.join(met, "id", "left").withColumn("_a", own + F.coalesce("_b", F.lit(0.0))).drop("_b")

    def _centred(self, table: DataFrame, numeric: np.ndarray) -> tuple[np.ndarray, float, float, float]:
        """From ``_product``: the numeric part of the centred product, the vector's mean over the
        rows, and the sums of p * _a and p * p over the categories. One row reaches the driver."""
        p = F.col("p")
        row = table.agg(*[F.coalesce(F.sum(e), F.lit(0.0)) for e in
                          (F.col("cnt") * p, p * F.col("_a"), p * p, *[F.col(x) * p for x in self.sums])]).first()
        # Numeric x numeric is centred already; the rest is raw sums.
        out = self.cuu @ numeric + np.array(row[3:], dtype=float) - self.mean_u * row[0]
        return out, float(self.mean_u @ numeric) + row[0] / self.n, row[1], row[2]

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The centred normal matrix times a vector that the driver holds (numeric part first)."""
        numeric, own = vector[:self.m], vector[self.m:]
        given = self.spark.createDataFrame([(i, float(v)) for i, v in enumerate(own)], "id long, p double")
        table = self._product(self.table.join(given, "id"), numeric)
        first, mean, _, _ = self._centred(table, numeric)
        rest = {r["id"]: r["q"] for r in table.select("id", (F.col("_a") - F.col("cnt") * F.lit(mean)).alias("q")).collect()}
        return np.concatenate([first, [rest[i] for i in range(self.size)]])

    def solve(self, alpha: float = 0.0, tol: float = 1e-13, max_iterations: int = 500) -> CategoryWeights:
        """Weights that minimise SSE + alpha * ||weights||^2 (intercept free), by conjugate gradients
        on the matrix scaled by its diagonal, until the residual is ``tol`` of the right side. Without
        a penalty the weights of each column are shifted to sum to zero, which changes no
        prediction and is the least norm where nothing else is dependent."""
        if alpha < 0:
            raise ValueError("alpha must not be negative.")
        alpha = float(alpha)
        diagonal = (np.diag(self.cuu) if self.m else np.zeros(0)) + alpha
        inverse = np.where(diagonal > 0, 1 / np.where(diagonal > 0, diagonal, 1), 0.0)
        cnt, inv, w, r, p = (F.col(x) for x in ("cnt", "inv", "w", "r", "p"))
        fixed = ["c", "category", "n", "id", "cnt", *self.sums]
        spread = cnt - cnt * cnt / F.lit(float(self.n)) + F.lit(alpha)
        state = (self.table.withColumn("inv", F.when(spread > 0, 1 / spread).otherwise(F.lit(0.0)))
                 .select(*fixed, "inv", F.lit(0.0).alias("w"), F.col("right").alias("r"), F.lit(0.0).alias("p"))
                 .persist(StorageLevel.MEMORY_AND_DISK))

        def residual() -> float:
            return float(r_num @ (inverse * r_num)) + (state.agg(F.sum(inv * r * r)).first()[0] or 0.0)

        w_num, r_num, p_num = np.zeros(self.m), self.cuy.copy(), np.zeros(self.m)
        rho, ratio, done = residual(), 0.0, 0
        goal = tol * tol * rho
        while rho > goal and done < max_iterations:
            p_num = inverse * r_num + ratio * p_num
            table = self._product(state.withColumn("p", inv * r + F.lit(ratio) * p), p_num)
            if self.pairs:
                table = table.persist(StorageLevel.MEMORY_AND_DISK)
            q_num, mean, pa, pp = self._centred(table, p_num)
            q_num = q_num + alpha * p_num
            # p . q; n * (mean of the categories' part) is the sum of cnt * p
            of_cnt = self.n * (mean - float(self.mean_u @ p_num))
            step = rho / (float(p_num @ q_num) + pa - of_cnt * mean + alpha * pp)
            w_num, r_num = w_num + step * p_num, r_num - step * q_num
            q = F.col("_a") - cnt * F.lit(mean) + F.lit(alpha) * p
            before, state = state, table.select(*fixed, "inv", (w + F.lit(step) * p).alias("w"),
                                                (r - F.lit(step) * q).alias("r"), "p").persist(StorageLevel.MEMORY_AND_DISK)
            last, rho = rho, residual()
            ratio, done = rho / last, done + 1
            before.unpersist()
            if self.pairs:
                table.unpersist()
            if self.pairs or done % LINEAGE == 0:   # a join with the pairs takes the lineage in twice
                held, state = state, materialize(state, "checkpoint")
                held.unpersist()
        if alpha == 0:
            shift = {x["c"]: x["m"] for x in state.groupBy("c").agg(F.avg("w").alias("m")).collect()}   # a row per column
            mean_w = F.coalesce(*[F.when(F.col("c") == i, F.lit(m)) for i, m in shift.items()], F.lit(0.0))
        else:
            mean_w = F.lit(0.0)
        found = materialize(state.select("c", "category", "n", "id", "cnt", (w - mean_w).alias("weight")), "checkpoint")
        of_cnt = found.agg(F.sum(cnt * F.col("weight"))).first()[0] or 0.0
        state.unpersist()
        intercept = self.mean_y - float(self.mean_u @ w_num) - of_cnt / self.n
        return CategoryWeights(intercept, w_num, found.drop("cnt"), done)
