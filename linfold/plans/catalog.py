"""Registered queries over the driver's tables, with their DuckDB oracle SQL.

Every query reads the given parquet tables in full; float outputs are rounded to six
significant digits in both engines (distributed sums are not bitwise reproducible).
The SQL is generated from the same parameters the Spark side uses, so the two never
drift apart; it is an independent formulation (raw sums, recursive CTEs, closed forms),
not a transcript of the Spark plan.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import (TWO_POW_52, line_count, line_count_sql, round_sig,
                                     round_sig_sql, word_count, word_count_sql)
from linfold.operators.categories import CategoryModel, NormalEquations
from linfold.operators.compare import compare_models
from linfold.operators.gd import fit_gd, initial_weights, predict
from linfold.operators.gram import chunk_gradients, gradient_frame, gram_stats, gram_sums_frame, loss_frame
from linfold.operators.linear import fit_ols, fit_ridge
from linfold.operators.metrics import evaluate
from linfold.operators.prepare import prepare_train_test_data
from linfold.operators.preprocess import Preprocessor, category_table, onehot_long
from linfold.operators.runlog import add_speedup, report_series, run_label, run_stats
from linfold.operators.select import exact_quantiles
from linfold.operators.sgd import fit_sgd, fit_sgd_rows
from linfold.operators.split import chunk_of, hash_test_flag, split_flag
from linfold.operators.target import TARGET_SCALE, split_target
from linfold.session import materialize, scratch_path
from linfold.sources.io import load_table, save_processed_splits, write_results, write_table
from linfold.sources.synth import synthetic_frame

SEED = 42
TEST_SIZE = 0.2
DOC_SCALE = 1000.0
GD_EPOCHS = 500
GD_LR = 0.01
COMPARE_ALPHA = 0.01
RIDGE_ALPHA = 50.0
GRAD_ALPHA = 0.05
GRAD_WEIGHTS = (0.1, 0.01, -0.5, 0.3)
PRED_WEIGHTS = (2.5, 3.0, 0.1)
ES_TOL, ES_PATIENCE, ES_EPOCHS = 1e-3, 5, 3000
SYNTH_FEATURES = 3
SGD_EPOCHS, SGD_BATCHES = 20, 16
LI_FEATURES = ["l_quantity", "l_discount", "l_tax"]
DOC_FEATURES = ["words", "lines"]
RUN_BASELINE = {"implementation": "click", "processes": 1}


# ----------------------------------------------------------------------------- helpers
def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


def _rounded(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else round_sig(c).alias(c) for c in df.columns])


def _d(x: float) -> str:
    """A DOUBLE literal for DuckDB (a bare decimal would be typed DECIMAL)."""
    x = float(x)
    if math.isinf(x):
        return "CAST('inf' AS DOUBLE)" if x > 0 else "CAST('-inf' AS DOUBLE)"
    return f"CAST({x!r} AS DOUBLE)"


def _rs(expr: str, name: str) -> str:
    return f"{round_sig_sql(expr)} AS {name}"


def _h52_sql(*parts: str) -> str:
    inner = ", ".join([f"'{SEED}'"] + list(parts))
    return f"('0x' || substr(md5(concat_ws(':', {inner})), 1, 13))::BIGINT"


def _test_sql(key: str) -> str:
    return f"(CAST({_h52_sql(f'CAST({key} AS VARCHAR)')} AS DOUBLE) < {_d(TEST_SIZE * TWO_POW_52)})"


def _lincomb_sql(weights: list[str], cols: list[str]) -> str:
    expr = weights[0]
    for w, c in zip(weights[1:], cols):
        expr = f"({expr} + {w} * {c})"
    return expr


def _metrics_sql(pred: str, y: str) -> list[str]:
    e = f"({pred} - {y})"
    sst = f"(var_pop({y}) * count({y}))"
    return [_rs(f"avg({e} * {e})", "MSE"), _rs(f"sqrt(avg({e} * {e}))", "RMSE"),
            _rs(f"avg(abs({e}))", "MAE"),
            _rs(f"CASE WHEN {sst} = 0 THEN 0.0 ELSE 1.0 - sum({e} * {e}) / {sst} END", "R2")]


# ----------------------------------------------------------------------------- documents
def _doc_frame(spark: SparkSession, sf: str) -> DataFrame:
    docs = _read(spark, sf, "documents")
    return docs.select("doc_id", word_count("text").alias("words"),
                       line_count("text").alias("lines"), "lang", "n_chars")


def _released(*args, **kwargs):
    """A prepare whose cache is dropped once the statistics are fitted: the query that goes on from
    it reads the table again, and leaves nothing cached."""
    prep = _kept(*args, **kwargs)
    prep.release()
    return prep


def _kept(*args, **kwargs):
    """The queries split by hash, whose membership SQL computes row by row."""
    return prepare_train_test_data(*args, split_mode="hash", **kwargs)


def _doc_prepared(spark: SparkSession, sf: str, prepare=_released):
    df = _doc_frame(spark, sf).drop("lang")
    return prepare(df, "n_chars", TEST_SIZE, SEED, DOC_SCALE, id_columns=["doc_id"])


_DOC_CTE = f"""docs AS (
  SELECT doc_id, {word_count_sql('text')} AS words, {line_count_sql('text')} AS lines, lang,
         CAST(n_chars AS DOUBLE) / {_d(DOC_SCALE)} AS n_chars, {_test_sql('doc_id')} AS is_test
  FROM documents),
dstats AS (
  SELECT avg(words) AS mw, stddev_pop(words) AS sw, avg(lines) AS ml, stddev_pop(lines) AS sl
  FROM docs WHERE NOT is_test),
prep AS (
  SELECT doc_id, is_test, lang, (words - mw) / sw AS words, (lines - ml) / sl AS lines, n_chars
  FROM docs CROSS JOIN dstats)"""


def _gram_sums_sql(features: list[str], y: str, source: str, name: str = "g") -> str:
    z = [_d(1.0)] + features
    k = len(z)
    sums = ["count(*) AS n"]
    sums += [f"sum({z[i]} * {z[j]}) AS g{i}_{j}" for i in range(k) for j in range(i, k)]
    sums += [f"sum({z[i]} * {y}) AS b{i}" for i in range(k)] + [f"sum({y} * {y}) AS c"]
    return f"{name} AS (SELECT {', '.join(sums)} FROM {source})"


def _g(i: int, j: int) -> str:
    return f"g{min(i, j)}_{max(i, j)}"


def _gd_step_sql(k: int, lr: float, alpha: float, w: list[str]) -> list[str]:
    out = []
    for i in range(k):
        gz = " + ".join(f"{_g(i, j)} * {w[j]}" for j in range(k))
        grad = f"2.0 * (({gz}) - b{i}) / n"
        if alpha and i > 0:
            grad = f"({grad} + {_d(2.0 * alpha)} * {w[i]})"
        out.append(f"{w[i]} - {_d(lr)} * ({grad})")
    return out


def _loss_sql(k: int, alpha: float, w: list[str]) -> str:
    quad = " + ".join(f"{w[i]} * {_g(i, j)} * {w[j]}" for i in range(k) for j in range(k))
    lin = " + ".join(f"{w[i]} * b{i}" for i in range(k))
    pen = ""
    if alpha:
        pen = " + " + _d(alpha) + " * (" + " + ".join(f"{w[i]} * {w[i]}" for i in range(1, k)) + ")"
    return f"(({quad}) - 2.0 * ({lin}) + c) / n{pen}"


def _gd_cte(features: list[str], epochs: int, lr: float, alpha: float, start=None) -> str:
    k = len(features) + 1
    w = [f"w{i}" for i in range(k)]
    init = ", ".join(_d(v) for v in (np.zeros(k) if start is None else start))
    step = ", ".join(f"{s} AS {w[i]}" for i, s in enumerate(_gd_step_sql(k, lr, alpha, w)))
    return f"""gd(epoch, {', '.join(w)}) AS (
  SELECT 0, {init}
  UNION ALL
  SELECT epoch + 1, {step} FROM gd CROSS JOIN g WHERE epoch < {epochs})"""


def _doc_train_gram_sql() -> str:
    return _gram_sums_sql(DOC_FEATURES, "n_chars", "prep WHERE NOT is_test")


# ----------------------------------------------------------------------------- P1, P3
def q_target_scale(spark, sf):
    li = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_FEATURES,
                                             "l_extendedprice")
    frame, _ = split_target(li, "l_extendedprice", TARGET_SCALE, ["l_orderkey", "l_linenumber"])
    return frame


SQL_TARGET_SCALE = f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax,
  l_extendedprice / {_d(TARGET_SCALE)} AS l_extendedprice FROM lineitem"""


def q_split_hash(spark, sf):
    return split_flag(_read(spark, sf, "part").select("p_partkey"), TEST_SIZE, SEED,
                      key="p_partkey", mode="hash")


SQL_SPLIT_HASH = f"""SELECT p_partkey, CASE WHEN {_test_sql('p_partkey')} THEN 'test' ELSE 'train' END AS split
FROM part"""


def q_split_exact(spark, sf):
    return split_flag(_read(spark, sf, "orders").select("o_orderkey"), TEST_SIZE, SEED,
                      key="o_orderkey", mode="exact")


SQL_SPLIT_EXACT = f"""WITH h AS (SELECT o_orderkey, {_h52_sql('CAST(o_orderkey AS VARCHAR)')} AS h FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY h, o_orderkey) AS rn, count(*) OVER () AS n FROM h)
SELECT o_orderkey, CASE WHEN rn <= ceil({_d(TEST_SIZE)} * n) THEN 'test' ELSE 'train' END AS split FROM r"""


def q_layout(spark, sf):
    """The gradient from 1, 3 and 8 chunks: identical rows. One scan sums up 24 chunks (formed by a
    hash of the row's key, no row is moved), of which the coarser ones are unions."""
    li = _li_frame(spark, sf, "l_orderkey")
    fine = chunk_gradients(li, LI_FEATURES, "y", GRAD_WEIGHTS, chunk_of("l_orderkey", 24, SEED))
    sums = ["n", *[f"g{j}" for j in range(len(GRAD_WEIGHTS))]]
    ways = (fine.withColumn("parallelism_factor", F.explode(F.array(F.lit(1), F.lit(3), F.lit(8))))
            .groupBy("parallelism_factor", (F.col("chunk") % F.col("parallelism_factor")).alias("chunk"))
            .agg(*[F.sum(c).alias(c) for c in sums]))
    total = ways.groupBy("parallelism_factor").agg(*[F.sum(c).alias(c) for c in sums])
    names = ["intercept", *LI_FEATURES]
    out = total.select("parallelism_factor", F.explode(F.array(*[
        F.struct(F.lit(j).alias("idx"), F.lit(name).alias("name"), (F.col(f"g{j}") / F.col("n")).alias("gradient"))
        for j, name in enumerate(names)])).alias("g")).select("g.*", "parallelism_factor")
    return _rounded(out, ["idx", "name", "parallelism_factor"])


CHUNKS = 8


def q_chunk_gradients(spark, sf):
    """A row per chunk: its rows and gradient sums."""
    li = _li_frame(spark, sf, "l_orderkey")
    return _rounded(chunk_gradients(li, LI_FEATURES, "y", GRAD_WEIGHTS, chunk_of("l_orderkey", CHUNKS, SEED, "md5")),
                    ["chunk", "n"])


def _chunk_gradients_sql() -> str:
    e = f"({_lincomb_sql([_d(v) for v in GRAD_WEIGHTS], LI_FEATURES)} - y)"
    sums = [f"2.0 * sum({e})"] + [f"2.0 * sum({e} * {x})" for x in LI_FEATURES]
    chunk = f"CAST({_h52_sql('CAST(l_orderkey AS VARCHAR)')} % {CHUNKS} AS INTEGER)"
    return (f"SELECT {chunk} AS chunk, count(*) AS n, {', '.join(_rs(v, f'g{j}') for j, v in enumerate(sums))} FROM "
            f"(SELECT *, l_extendedprice / {_d(TARGET_SCALE)} AS y FROM lineitem) GROUP BY 1")


def q_gradient_null(spark, sf):
    """Rows with NULL, NaN or infinite values left out by ``invalid="skip"``."""
    key = F.col("l_orderkey")
    li = _li_frame(spark, sf, "l_orderkey").withColumn("l_quantity", F.when(key % 7 == 0, F.lit(None))
                                                       .when(key % 11 == 0, F.lit(float("nan")))
                                                       .when(key % 13 == 0, F.lit(float("inf")))
                                                       .otherwise(F.col("l_quantity")))
    return _rounded(gradient_frame(li, LI_FEATURES, "y", GRAD_WEIGHTS, invalid="skip"), ["idx", "name"])


# ----------------------------------------------------------------------------- E1-E7
def q_impute_median(spark, sf):
    cust = _read(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal"))
        .alias("c_acctbal"))
    train = cust.filter(~hash_test_flag(SEED, ["c_custkey"], TEST_SIZE))
    med = exact_quantiles(train, ["c_acctbal"], 0.5)["c_acctbal"]
    out = cust.select("c_custkey", F.coalesce("c_acctbal", F.lit(med)).alias("c_acctbal"))
    return _rounded(out, ["c_custkey"])


SQL_IMPUTE_MEDIAN = f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
  {_test_sql('c_custkey')} AS is_test FROM customer),
m AS (SELECT median(c_acctbal) AS med FROM c WHERE NOT is_test)
SELECT c_custkey, {_rs('coalesce(c_acctbal, med)', 'c_acctbal')} FROM c CROSS JOIN m"""


def q_scale(spark, sf):
    li = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LI_FEATURES,
                                             "l_extendedprice")
    feats = LI_FEATURES + ["l_extendedprice"]
    train = li.filter(~hash_test_flag(SEED, ["l_orderkey", "l_linenumber"], TEST_SIZE))
    kept = materialize(train.select(*feats))
    model = Preprocessor(feats).fit(kept)
    kept.unpersist()
    return _rounded(model.transform(li, ["l_orderkey", "l_linenumber"]),
                    ["l_orderkey", "l_linenumber"])


def _scale_sql() -> str:
    feats = LI_FEATURES + ["l_extendedprice"]
    flag = (f"(CAST({_h52_sql('CAST(l_orderkey AS VARCHAR)', 'CAST(l_linenumber AS VARCHAR)')}"
            f" AS DOUBLE) < {_d(TEST_SIZE * TWO_POW_52)})")
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in feats)
    sel = ", ".join(_rs(f"({c} - m_{c}) / s_{c}", c) for c in feats)
    return f"""WITH t AS (SELECT *, {flag} AS is_test FROM lineitem),
s AS (SELECT {stats} FROM t WHERE NOT is_test)
SELECT {sel}, l_orderkey, l_linenumber FROM t CROSS JOIN s"""


def q_impute_mode(spark, sf):
    cust = _read(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))
    train = cust.filter(~hash_test_flag(SEED, ["c_custkey"], TEST_SIZE))
    mode = Preprocessor(["c_mktsegment"]).fit(train).modes["c_mktsegment"]
    return cust.select("c_custkey", F.coalesce("c_mktsegment", F.lit(mode)).alias("c_mktsegment"))


SQL_IMPUTE_MODE = f"""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
  {_test_sql('c_custkey')} AS is_test FROM customer),
m AS (SELECT c_mktsegment AS mode FROM c WHERE NOT is_test AND c_mktsegment IS NOT NULL
      GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1)
SELECT c_custkey, coalesce(c_mktsegment, mode) AS c_mktsegment FROM c CROSS JOIN m"""


def q_onehot(spark, sf):
    orders = _read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    train = orders.filter(~hash_test_flag(SEED, ["o_orderkey"], TEST_SIZE)
                          & (F.col("o_orderstatus") != "P"))
    model = Preprocessor(["o_orderstatus"]).fit(train)
    return model.transform(orders, ["o_orderkey"])


SQL_ONEHOT = """SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END::DOUBLE AS o_orderstatus_F,
  CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS o_orderstatus_O, o_orderkey FROM orders"""


def q_preprocess(spark, sf):
    df = _doc_frame(spark, sf).select(
        "doc_id", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("words")).alias("words"),
        "lines", F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.col("lang")).alias("lang"),
        "n_chars")
    prep = _released(df, "n_chars", TEST_SIZE, SEED, DOC_SCALE, id_columns=["doc_id"])
    out = prep.train.unionByName(prep.test)
    return _rounded(out, ["doc_id"])


def _preprocess_sql() -> str:
    langs = ["de", "en", "es", "fr"]
    onehot = ", ".join(f"CASE WHEN coalesce(lang, mode) = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS lang_{v}"
                       for v in langs)
    return f"""WITH raw AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE {word_count_sql('text')} END AS words,
         {line_count_sql('text')} AS lines, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS lang,
         CAST(n_chars AS DOUBLE) / {_d(DOC_SCALE)} AS n_chars, {_test_sql('doc_id')} AS is_test
  FROM documents),
med AS (SELECT median(words) AS mw0, median(lines) AS ml0 FROM raw WHERE NOT is_test),
filled AS (SELECT raw.*, coalesce(words, mw0) AS fw, coalesce(lines, ml0) AS fl FROM raw CROSS JOIN med),
st AS (SELECT avg(fw) AS mw, stddev_pop(fw) AS sw, avg(fl) AS ml, stddev_pop(fl) AS sl FROM filled WHERE NOT is_test),
md AS (SELECT lang AS mode FROM raw WHERE NOT is_test AND lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
SELECT doc_id, {_rs('(fw - mw) / sw', 'words')}, {_rs('(fl - ml) / sl', 'lines')}, {onehot}, {_rs('n_chars', 'n_chars')}
FROM filled CROSS JOIN st CROSS JOIN md"""


def _part_frame(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", "p_size", "p_brand", "p_type",
                                           "p_retailprice")


def q_prepare(spark, sf):
    prep = _released(_part_frame(spark, sf), "p_retailprice", TEST_SIZE, SEED,
                                   DOC_SCALE, id_columns=["p_partkey"])
    both = (prep.train.withColumn("split", F.lit("train"))
            .unionByName(prep.test.withColumn("split", F.lit("test"))))
    cols = prep.feature_names + ["p_retailprice"]
    long = both.unpivot(["p_partkey", "split"], cols, "feature", "value")
    return _rounded(long, ["p_partkey", "split", "feature"])


SQL_PREPARE = f"""WITH t AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_brand, p_type,
  p_retailprice / {_d(DOC_SCALE)} AS p_retailprice, {_test_sql('p_partkey')} AS is_test FROM part),
st AS (SELECT avg(p_size) AS m, stddev_pop(p_size) AS s FROM t WHERE NOT is_test),
cats AS (SELECT DISTINCT 'p_brand' AS col, p_brand AS v FROM t WHERE NOT is_test
         UNION ALL SELECT DISTINCT 'p_type', p_type FROM t WHERE NOT is_test),
feats AS (
  SELECT p_partkey, is_test, 'p_size' AS feature, (p_size - m) / s AS value FROM t CROSS JOIN st
  UNION ALL
  SELECT p_partkey, is_test, col || '_' || v, CASE WHEN (CASE col WHEN 'p_brand' THEN p_brand ELSE p_type END) = v
         THEN 1.0 ELSE 0.0 END::DOUBLE FROM t CROSS JOIN cats
  UNION ALL
  SELECT p_partkey, is_test, 'p_retailprice', p_retailprice FROM t)
SELECT p_partkey, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, feature, {_rs('value', 'value')} FROM feats"""


def q_prepare_exact(spark, sf):
    """The size-exact split inside prepare: test holds ceil(test_size * n) rows."""
    prep = prepare_train_test_data(_part_frame(spark, sf).select("p_partkey", "p_size", "p_retailprice"),
                                   "p_retailprice", TEST_SIZE, SEED, DOC_SCALE, id_columns=["p_partkey"])
    prep.release()
    both = (prep.train.withColumn("split", F.lit("train"))
            .unionByName(prep.test.withColumn("split", F.lit("test"))))
    return _rounded(both.select("p_partkey", "split", "p_size", "p_retailprice"), ["p_partkey", "split"])


SQL_PREPARE_EXACT = f"""WITH h AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice / {_d(DOC_SCALE)} AS y,
  row_number() OVER (ORDER BY {_h52_sql('CAST(p_partkey AS VARCHAR)')}, p_partkey) <= ceil({_d(TEST_SIZE)} * count(*) OVER ()) AS is_test
  FROM part),
st AS (SELECT avg(size) AS m, stddev_pop(size) AS s FROM h WHERE NOT is_test)
SELECT p_partkey, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, {_rs('(size - m) / s', 'p_size')},
  {_rs('y', 'p_retailprice')} FROM h CROSS JOIN st"""


def q_vector(spark, sf):
    """The prepared features as one sparse vector: its non-zero entries as rows."""
    from pyspark.ml.functions import vector_to_array
    prep = _doc_onehot_prepared(spark, sf)
    both = prep.raw_test.unionByName(prep.kept)
    vectors = prep.preprocessor.transform_vector(both, ["doc_id"])
    long = vectors.select("doc_id", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return _rounded(long.where("value <> 0"), ["doc_id", "position"])


def _vector_sql() -> str:
    parts = [f"SELECT doc_id, {i} AS position, {c} AS v FROM t" for i, c in enumerate(ONEHOT_FEATURES)]
    return (f"WITH {_ONEHOT_CTE},\nv AS ({' UNION ALL '.join(parts)})\n"
            f"SELECT doc_id, CAST(position AS INTEGER) AS position, {_rs('v', 'value')} FROM v WHERE v <> 0")


# ----------------------------------------------------------------------------- G1-G11
def _li_frame(spark, sf, *keys):
    li = _read(spark, sf, "lineitem")
    return li.select(*keys, *LI_FEATURES, (F.col("l_extendedprice") / F.lit(TARGET_SCALE)).alias("y"))


_LI_CTE = f"""li AS (SELECT l_orderkey, l_quantity, l_discount, l_tax, l_extendedprice / {_d(TARGET_SCALE)} AS y FROM lineitem)"""


def _gram_rows(spark, st, y_name: str) -> DataFrame:
    g, b, c = st.raw()
    names = ["intercept"] + list(st.features)
    rows = [(names[i], names[j], float(g[i, j])) for i in range(len(names))
            for j in range(i, len(names))]
    rows += [(names[i], y_name, float(b[i])) for i in range(len(names))] + [(y_name, y_name, float(c))]
    return _rounded(spark.createDataFrame(rows, "row_name string, col_name string, value double"),
                    ["row_name", "col_name"])


def q_gram(spark, sf):
    return _rounded(gram_sums_frame(_li_frame(spark, sf), LI_FEATURES, "y"),
                    ["row_name", "col_name"])


def _gram_sql() -> str:
    names = ["intercept"] + LI_FEATURES
    z = [_d(1.0)] + LI_FEATURES
    parts = []
    for i in range(len(z)):
        for j in range(i, len(z)):
            parts.append(f"SELECT '{names[i]}' AS row_name, '{names[j]}' AS col_name, "
                         f"{_rs(f'sum({z[i]} * {z[j]})', 'value')} FROM li")
    for i in range(len(z)):
        parts.append(f"SELECT '{names[i]}', 'y', {round_sig_sql(f'sum({z[i]} * y)')} FROM li")
    parts.append(f"SELECT 'y', 'y', {round_sig_sql('sum(y * y)')} FROM li")
    return f"WITH {_LI_CTE}\n" + "\nUNION ALL ".join(parts)


def q_gram_onehot(spark, sf):
    prep = _released(_doc_frame(spark, sf), "n_chars", TEST_SIZE, SEED, DOC_SCALE,
                                   id_columns=["doc_id"])
    return _gram_rows(spark, prep.gram_stats(), "y")


def _gram_onehot_sql() -> str:
    langs = ["de", "en", "es", "fr"]
    feats = DOC_FEATURES + [f"lang_{v}" for v in langs]
    onehot = ", ".join(f"CASE WHEN lang = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS lang_{v}" for v in langs)
    z = [_d(1.0)] + feats
    names = ["intercept"] + feats
    parts = []
    for i in range(len(z)):
        for j in range(i, len(z)):
            parts.append(f"SELECT '{names[i]}' AS row_name, '{names[j]}' AS col_name, "
                         f"{_rs(f'sum({z[i]} * {z[j]})', 'value')} FROM t")
    for i in range(len(z)):
        parts.append(f"SELECT '{names[i]}', 'y', {round_sig_sql(f'sum({z[i]} * n_chars)')} FROM t")
    parts.append(f"SELECT 'y', 'y', {round_sig_sql('sum(n_chars * n_chars)')} FROM t")
    return (f"WITH {_DOC_CTE},\nt AS (SELECT words, lines, {onehot}, n_chars FROM prep "
            f"WHERE NOT is_test)\n" + "\nUNION ALL ".join(parts))


def _q_gradient(alpha):
    def run(spark, sf):
        out = gradient_frame(_li_frame(spark, sf), LI_FEATURES, "y", GRAD_WEIGHTS, alpha)
        return _rounded(out, ["idx", "name"])
    return run


def _gradient_sql(alpha: float, partitions: bool = False, where: str = "") -> str:
    w = [_d(v) for v in GRAD_WEIGHTS]
    e = f"({_lincomb_sql(w, LI_FEATURES)} - y)"
    names = ["intercept"] + LI_FEATURES
    xs = [None] + LI_FEATURES
    parts = []
    for i, name in enumerate(names):
        s = f"sum({e})" if i == 0 else f"sum({e} * {xs[i]})"
        ridge = 0.0 if i == 0 else 2.0 * alpha * GRAD_WEIGHTS[i]
        parts.append(f"SELECT {i} AS idx, '{name}' AS name, "
                     f"{_rs(f'2.0 * {s} / count(*) + {_d(ridge)}', 'gradient')} FROM li{where}")
    body = "\nUNION ALL ".join(parts)
    if not partitions:
        return f"WITH {_LI_CTE}\n{body}"
    return (f"WITH {_LI_CTE}, gr AS ({body})\n"
            "SELECT gr.*, p.parallelism_factor FROM gr CROSS JOIN (VALUES (1), (3), (8)) "
            "AS p(parallelism_factor)")


def q_loss(spark, sf):
    out = loss_frame(_li_frame(spark, sf), LI_FEATURES, "y", GRAD_WEIGHTS, GRAD_ALPHA)
    return _rounded(out, ["n"])


def _loss_query_sql() -> str:
    w = [_d(v) for v in GRAD_WEIGHTS]
    e = f"({_lincomb_sql(w, LI_FEATURES)} - y)"
    pen = GRAD_ALPHA * float(np.sum(np.asarray(GRAD_WEIGHTS[1:]) ** 2))
    return (f"WITH {_LI_CTE}\nSELECT count(*) AS n, {_rs(f'avg({e} * {e})', 'mse')}, "
            f"{_rs(_d(pen), 'penalty')}, {_rs(f'avg({e} * {e}) + {_d(pen)}', 'loss')} FROM li")


def _doc_gd(spark, sf, early_stopping=False):
    prep = _doc_prepared(spark, sf, _kept)
    options = dict(epochs=ES_EPOCHS, early_stopping=True, tol=ES_TOL, patience=ES_PATIENCE) if early_stopping \
        else dict(epochs=GD_EPOCHS)
    try:
        return fit_gd(prep.train, DOC_FEATURES, "n_chars", learning_rate=GD_LR,
                      initial=np.zeros(len(DOC_FEATURES) + 1), **options)
    finally:
        prep.release()


def q_gd_weights(spark, sf):
    return _rounded(_doc_gd(spark, sf).weights_frame(spark), ["idx", "name"])


def _gd_weights_sql() -> str:
    k = len(DOC_FEATURES) + 1
    names = ["intercept"] + DOC_FEATURES
    sel = "\nUNION ALL ".join(
        f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')} FROM gd WHERE epoch = {GD_EPOCHS}"
        for i in range(k))
    return (f"WITH RECURSIVE {_DOC_CTE},\n{_doc_train_gram_sql()},\n"
            f"{_gd_cte(DOC_FEATURES, GD_EPOCHS, GD_LR, 0.0)}\n{sel}")


PER_EPOCH_EPOCHS, SEEDED_EPOCHS = 10, 50


def q_gd_per_epoch(spark, sf):
    """The solver that reads the data once per epoch, with a ridge term."""
    prep = _doc_prepared(spark, sf, _kept)
    try:
        res = fit_gd(prep.train, DOC_FEATURES, "n_chars", PER_EPOCH_EPOCHS, 0.1, GRAD_ALPHA, solver="per_epoch",
                     initial=np.zeros(len(DOC_FEATURES) + 1))
    finally:
        prep.release()
    return _rounded(res.weights_frame(spark), ["idx", "name"])


def q_gd_seeded(spark, sf):
    """From the seeded random start."""
    prep = _doc_prepared(spark, sf, _kept)
    try:
        res = fit_gd(prep.train, DOC_FEATURES, "n_chars", SEEDED_EPOCHS, GD_LR, random_state=SEED)
    finally:
        prep.release()
    return _rounded(res.weights_frame(spark), ["idx", "name"])


def _gd_variant_sql(epochs: int, lr: float, alpha: float, start=None) -> str:
    names = ["intercept", *DOC_FEATURES]
    sel = "\nUNION ALL ".join(
        f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')} FROM gd WHERE epoch = {epochs}"
        for i in range(len(names)))
    return (f"WITH RECURSIVE {_DOC_CTE},\n{_doc_train_gram_sql()},\n"
            f"{_gd_cte(DOC_FEATURES, epochs, lr, alpha, start)}\n{sel}")


def q_gd_history(spark, sf):
    hist = _doc_gd(spark, sf).history_frame(spark, "spark_gram")
    return _rounded(hist, ["run", "epoch"])


def _gd_history_sql() -> str:
    k = len(DOC_FEATURES) + 1
    w = [f"w{i}" for i in range(k)]
    return (f"WITH RECURSIVE {_DOC_CTE},\n{_doc_train_gram_sql()},\n"
            f"{_gd_cte(DOC_FEATURES, GD_EPOCHS, GD_LR, 0.0)}\n"
            f"SELECT 'spark_gram' AS run, CAST(epoch AS INTEGER) AS epoch, {_rs(_loss_sql(k, 0.0, w), 'loss')} "
            f"FROM gd CROSS JOIN g WHERE epoch >= 1")


def q_gd_early_stop(spark, sf):
    res = _doc_gd(spark, sf, early_stopping=True)
    return _rounded(res.weights_frame(spark).withColumn("n_epochs", F.lit(res.n_epochs)),
                    ["idx", "name", "n_epochs"])


def _gd_early_stop_sql() -> str:
    k = len(DOC_FEATURES) + 1
    w = [f"w{i}" for i in range(k)]
    names = ["intercept"] + DOC_FEATURES
    step = ", ".join(f"{s} AS {w[i]}" for i, s in enumerate(_gd_step_sql(k, GD_LR, 0.0, w)))
    wl = ", ".join(w)
    tol = _d(ES_TOL)
    es = f"""es(epoch, {wl}, best, stale, stop) AS (
  SELECT 0, {', '.join([_d(0.0)] * k)}, CAST('inf' AS DOUBLE), 0, false
  UNION ALL
  SELECT epoch, {wl},
         CASE WHEN best - loss > {tol} THEN loss ELSE best END,
         CASE WHEN best - loss > {tol} THEN 0 ELSE stale + 1 END,
         CASE WHEN best - loss > {tol} THEN false ELSE stale + 1 >= {ES_PATIENCE} END
  FROM (SELECT t.*, {_loss_sql(k, 0.0, w)} AS loss FROM (
          SELECT es.epoch + 1 AS epoch, {step}, es.best, es.stale
          FROM es CROSS JOIN g WHERE NOT es.stop AND es.epoch < {ES_EPOCHS}) t CROSS JOIN g) u)"""
    sel = "\nUNION ALL ".join(
        f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')}, epoch AS n_epochs "
        f"FROM es WHERE epoch = (SELECT max(epoch) FROM es)" for i in range(k))
    return f"WITH RECURSIVE {_DOC_CTE},\n{_doc_train_gram_sql()},\n{es}\n{sel}"


def q_predict(spark, sf):
    prep = _doc_prepared(spark, sf)
    both = prep.train.unionByName(prep.test)
    out = predict(both, PRED_WEIGHTS, DOC_FEATURES).select("doc_id", "prediction")
    return _rounded(out, ["doc_id"])


def _pred_sql() -> str:
    return _lincomb_sql([_d(v) for v in PRED_WEIGHTS], DOC_FEATURES)


SQL_PREDICT = f"WITH {_DOC_CTE}\nSELECT doc_id, {_rs(_pred_sql(), 'prediction')} FROM prep"


LANGS = ["de", "en", "es", "fr"]
ONEHOT_FEATURES = DOC_FEATURES + [f"lang_{v}" for v in LANGS]
ONEHOT_PRED_WEIGHTS = (2.0, 3.0, 0.1, 0.4, -0.2, 0.3, 0.05)


def _doc_onehot_prepared(spark, sf, prepare=_released):
    return prepare(_doc_frame(spark, sf), "n_chars", TEST_SIZE, SEED, DOC_SCALE, id_columns=["doc_id"])


_ONEHOT_CTE = (f"{_DOC_CTE},\nt AS (SELECT doc_id, is_test, words, lines, "
               + ", ".join(f"CASE WHEN lang = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS lang_{v}"
                           for v in LANGS)
               + ", n_chars FROM prep)")


def q_predict_onehot(spark, sf):
    """Predictions of a one-hot design straight from the raw columns (map lookup)."""
    prep = _doc_onehot_prepared(spark, sf)
    assert prep.feature_names == ONEHOT_FEATURES
    raw = prep.raw_test.unionByName(prep.kept)
    out = raw.select("doc_id", prep.preprocessor.prediction_column(ONEHOT_PRED_WEIGHTS, raw.schema)
                     .alias("prediction"))
    return _rounded(out, ["doc_id"])


SQL_PREDICT_ONEHOT = (f"WITH {_ONEHOT_CTE}\nSELECT doc_id, "
                      f"{_rs(_lincomb_sql([_d(v) for v in ONEHOT_PRED_WEIGHTS], ONEHOT_FEATURES), 'prediction')} FROM t")


def q_gd_onehot(spark, sf):
    """GD on a one-hot design (singular with the intercept) through the grouped passes."""
    prep = _doc_onehot_prepared(spark, sf, _kept)
    try:
        res = prep.fit_gd(epochs=GD_EPOCHS, learning_rate=GD_LR, initial=np.zeros(len(prep.feature_names) + 1))
    finally:
        prep.release()
    return _rounded(res.weights_frame(spark), ["idx", "name"])


def _gd_onehot_sql() -> str:
    k = len(ONEHOT_FEATURES) + 1
    names = ["intercept"] + ONEHOT_FEATURES
    sel = "\nUNION ALL ".join(
        f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')} FROM gd WHERE epoch = {GD_EPOCHS}"
        for i in range(k))
    return (f"WITH RECURSIVE {_ONEHOT_CTE},\n"
            f"{_gram_sums_sql(ONEHOT_FEATURES, 'n_chars', 't WHERE NOT is_test')},\n"
            f"{_gd_cte(ONEHOT_FEATURES, GD_EPOCHS, GD_LR, 0.0)}\n{sel}")


# ----------------------------------------------------------------------------- B1-B4
def q_ols(spark, sf):
    frame, _ = split_target(_read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"),
                            "p_retailprice", DOC_SCALE)
    train = frame.filter(~hash_test_flag(SEED, ["p_partkey"], TEST_SIZE))
    model = fit_ols(train, ["p_partkey", "p_size"], "p_retailprice")
    return _rounded(model.weights_frame(spark), ["idx", "name"])


def _closed_form_sql(source: str, x1: str, x2: str, y: str, alpha: float, names: list[str], rounded: bool = True) -> str:
    a = _d(alpha)
    shown = round_sig_sql if rounded else str
    return f"""c AS (SELECT avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my,
  var_pop({x1}) * count(*) + {a} AS a11, covar_pop({x1}, {x2}) * count(*) AS a12,
  var_pop({x2}) * count(*) + {a} AS a22, covar_pop({x1}, {y}) * count(*) AS r1,
  covar_pop({x2}, {y}) * count(*) AS r2 FROM {source}),
sol AS (SELECT (a22 * r1 - a12 * r2) / (a11 * a22 - a12 * a12) AS v1,
  (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS v2, m1, m2, my FROM c)
SELECT 0 AS idx, '{names[0]}' AS name, {shown('my - v1 * m1 - v2 * m2')} AS weight FROM sol
UNION ALL SELECT 1, '{names[1]}', {shown('v1')} FROM sol
UNION ALL SELECT 2, '{names[2]}', {shown('v2')} FROM sol"""


SQL_OLS = (f"WITH t AS (SELECT CAST(p_partkey AS DOUBLE) AS x1, CAST(p_size AS DOUBLE) AS x2, "
           f"p_retailprice / {_d(DOC_SCALE)} AS y FROM part WHERE NOT {_test_sql('p_partkey')}),\n"
           + _closed_form_sql("t", "x1", "x2", "y", 0.0, ["intercept", "p_partkey", "p_size"]))


def _scales_frame(spark, sf):
    """Two features whose deviations differ by about 1e9, both with a real effect."""
    li = _read(spark, sf, "lineitem").select((F.col("l_extendedprice") * 1000.0).alias("x1"),
                                             F.col("l_discount").alias("x2"), "l_tax")
    return li.select("x1", "x2", (F.lit(1.0) + F.col("x1") * 1e-8 + F.col("x2") * 3.0 + F.col("l_tax")).alias("y"))


def q_ols_scales(spark, sf):
    model = fit_ols(_scales_frame(spark, sf), ["x1", "x2"], "y")
    return _rounded(model.weights_frame(spark), ["idx", "name"])


SQL_OLS_SCALES = ("WITH t AS (SELECT x1, x2, 1.0::DOUBLE + x1 * 1e-8 + x2 * 3.0::DOUBLE + l_tax AS y FROM (SELECT "
                  "l_extendedprice * 1000.0::DOUBLE AS x1, l_discount AS x2, l_tax FROM lineitem)),\n"
                  + _closed_form_sql("t", "x1", "x2", "y", 0.0, ["intercept", "x1", "x2"]))


COLLINEAR = 2.0 ** -22   # about 2e-7 beside a feature of size 1 to 50
COLLINEAR_DIGITS = 5     # a condition of 10**8 leaves that many digits for certain


def _collinear_frame(spark, sf):
    """Two features that differ by some 1e-8 of their size; both have a weight of their own."""
    li = _read(spark, sf, "lineitem").select(F.col("l_quantity").alias("x1"), "l_linenumber", "l_extendedprice")
    return li.select("x1", (F.col("x1") + F.col("l_linenumber") * F.lit(COLLINEAR)).alias("x2"),
                     (F.col("l_extendedprice") / F.lit(DOC_SCALE) + F.lit(8.0) * F.col("l_linenumber")).alias("y"))


def q_ols_collinear(spark, sf):
    model = fit_ols(_collinear_frame(spark, sf), ["x1", "x2"], "y")
    return model.weights_frame(spark).select("idx", "name", round_sig("weight", COLLINEAR_DIGITS).alias("weight"))


# The same design with x1 and the scaled difference as features, which are nearly orthogonal.
SQL_OLS_COLLINEAR = (
    f"WITH t AS (SELECT l_quantity AS x1, CAST(l_linenumber AS DOUBLE) AS x2, l_extendedprice / {_d(DOC_SCALE)} + 8.0::DOUBLE * l_linenumber AS y FROM lineitem),\n"
    f"f AS (SELECT * FROM (WITH {_closed_form_sql('t', 'x1', 'x2', 'y', 0.0, ['i', 'a', 'b'], rounded=False)})),\n"
    "w AS (SELECT max(CASE WHEN name = 'i' THEN weight END) AS i, max(CASE WHEN name = 'a' THEN weight END) AS a, "
    f"max(CASE WHEN name = 'b' THEN weight END) / {_d(COLLINEAR)} AS b FROM f)\n"
    f"SELECT 0 AS idx, 'intercept' AS name, {round_sig_sql('i', COLLINEAR_DIGITS)} AS weight FROM w UNION ALL "
    f"SELECT 1, 'x1', {round_sig_sql('a - b', COLLINEAR_DIGITS)} FROM w UNION ALL "
    f"SELECT 2, 'x2', {round_sig_sql('b', COLLINEAR_DIGITS)} FROM w")


def q_onehot_many(spark, sf):
    """One-hot of a column with very many categories, as rows: train categories are a table, and
    test rows join it."""
    li = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    test = hash_test_flag(SEED, ["l_orderkey"], TEST_SIZE)
    columns = ["l_partkey", "l_returnflag"]
    return onehot_long(li.where(test), columns, category_table(li.where(~test), columns),
                       ["l_orderkey", "l_linenumber"])


SQL_ONEHOT_MANY = f"""WITH l AS (SELECT *, {_test_sql('l_orderkey')} AS is_test FROM lineitem),
e AS (SELECT l_orderkey, l_linenumber, 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS category, is_test FROM l
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', l_returnflag, is_test FROM l),
c AS (SELECT DISTINCT "column", category FROM e WHERE NOT is_test)
SELECT l_orderkey, l_linenumber, e."column", e.category FROM e JOIN c ON e."column" = c."column" AND e.category = c.category
WHERE is_test"""


CATEGORY_ALPHA = 2.0


def _category_frames(spark, sf):
    """Rows of lineitem with their order's key as a category: about a category for four rows."""
    li = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order"),
                                             "l_quantity", "l_returnflag",
                                             (F.col("l_extendedprice") / F.lit(DOC_SCALE)).alias("y"))
    test = hash_test_flag(SEED, ["l_orderkey", "l_linenumber"], TEST_SIZE)
    return li.where(~test), li.where(test)


def q_category_transform(spark, sf):
    """The ones of the design as rows; orders without a train row have none."""
    train, test = _category_frames(spark, sf)
    return CategoryModel.fit(train, ["l_returnflag", "order"]).transform(test, ["l_orderkey", "l_linenumber"])


def q_category_ridge(spark, sf):
    """Ridge on a numeric column and a category for every order, by conjugate gradients on
    co-occurrence rows; predictions of test rows by a join."""
    train, test = _category_frames(spark, sf)
    model = CategoryModel.fit(train, ["l_quantity", "order"])
    equations = NormalEquations(train, model, "y")
    try:
        weights = equations.solve(CATEGORY_ALPHA)
    finally:
        equations.release()
    out = model.predict(test, weights).select("l_orderkey", "l_linenumber", "prediction")
    return _rounded(out, ["l_orderkey", "l_linenumber"])


_CATEGORY_CTE = f"""t AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice / {_d(DOC_SCALE)} AS y,
  (CAST({_h52_sql('CAST(l_orderkey AS VARCHAR)', 'CAST(l_linenumber AS VARCHAR)')} AS DOUBLE)
   < {_d(TEST_SIZE * TWO_POW_52)}) AS is_test FROM lineitem)"""

SQL_CATEGORY_TRANSFORM = f"""WITH {_CATEGORY_CTE},
e AS (SELECT l_orderkey, l_linenumber, is_test, 'l_returnflag' AS "column", l_returnflag AS category FROM t
  UNION ALL SELECT l_orderkey, l_linenumber, is_test, 'order', CAST(l_orderkey AS VARCHAR) FROM t),
c AS (SELECT "column", category, row_number() OVER (ORDER BY "column", category) - 1 AS id
  FROM (SELECT DISTINCT "column", category FROM e WHERE NOT is_test))
SELECT l_orderkey, l_linenumber, e."column", e.category, id FROM e JOIN c ON e."column" = c."column" AND e.category = c.category
WHERE is_test"""

# The categories' weights eliminated: each order's block shrinks its sums by n / (n + alpha).
SQL_CATEGORY_RIDGE = f"""WITH {_CATEGORY_CTE},
s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM t WHERE NOT is_test),
p AS (SELECT l_orderkey, l_linenumber, is_test, (l_quantity - m) / sd AS x, y FROM t CROSS JOIN s),
g AS (SELECT l_orderkey AS k, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy
  FROM p WHERE NOT is_test GROUP BY 1),
e AS (SELECT sum(n - n * n / (n + {_d(CATEGORY_ALPHA)})) AS a00, sum(sx - n * sx / (n + {_d(CATEGORY_ALPHA)})) AS a01,
  sum(sxx - sx * sx / (n + {_d(CATEGORY_ALPHA)})) + {_d(CATEGORY_ALPHA)} AS a11,
  sum(sy - n * sy / (n + {_d(CATEGORY_ALPHA)})) AS b0, sum(sxy - sx * sy / (n + {_d(CATEGORY_ALPHA)})) AS b1 FROM g),
w AS (SELECT (b0 * a11 - a01 * b1) / (a00 * a11 - a01 * a01) AS i, (a00 * b1 - a01 * b0) / (a00 * a11 - a01 * a01) AS b FROM e)
SELECT l_orderkey, l_linenumber,
  {_rs(f'i + b * x + coalesce((sy - n * i - b * sx) / (n + {_d(CATEGORY_ALPHA)}), 0.0)', 'prediction')}
FROM p CROSS JOIN w LEFT JOIN g ON g.k = p.l_orderkey WHERE is_test"""

EMBEDDING = 64


def q_gram_wide(spark, sf):
    """Gram statistics of a wide design (the block product): centred co-moments and means."""
    emb = _read(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(EMBEDDING)]
    frame = emb.select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)],
                       F.col("label").cast("double").alias("y"))
    st = gram_stats(frame, names, "y")
    rows = [(i, j, float(st.cxx[i, j])) for i in range(EMBEDDING) for j in range(i, EMBEDDING)]
    rows += [(i, EMBEDDING, float(st.cxy[i])) for i in range(EMBEDDING)] + [(EMBEDDING, EMBEDDING, st.cyy)]
    rows += [(i, -1, float(st.mean_x[i])) for i in range(EMBEDDING)] + [(EMBEDDING, -1, st.mean_y)]
    return _rounded(spark.createDataFrame(rows, "i int, j int, value double"), ["i", "j"])


SQL_GRAM_WIDE = f"""WITH v AS (SELECT vec_id, i, CASE WHEN i = {EMBEDDING} THEN CAST(label AS DOUBLE)
  ELSE CAST(embedding[i + 1] AS DOUBLE) END AS x FROM embeddings, (SELECT unnest(range({EMBEDDING + 1})) AS i)),
p AS (SELECT a.i, b.i AS j, covar_pop(a.x, b.x) * count(*) AS value FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i <= b.i
  GROUP BY a.i, b.i UNION ALL SELECT i, -1, avg(x) FROM v GROUP BY i)
SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, {_rs('value', 'value')} FROM p"""


def q_ridge(spark, sf):
    prep = _doc_prepared(spark, sf)
    model = fit_ridge(prep.train, DOC_FEATURES, "n_chars", RIDGE_ALPHA)
    return _rounded(model.weights_frame(spark), ["idx", "name"])


SQL_RIDGE = (f"WITH {_DOC_CTE},\ntr AS (SELECT * FROM prep WHERE NOT is_test),\n"
             + _closed_form_sql("tr", "words", "lines", "n_chars", RIDGE_ALPHA,
                                ["intercept"] + DOC_FEATURES))


def q_metrics(spark, sf):
    prep = _doc_prepared(spark, sf)
    return _rounded(evaluate(predict(prep.test, PRED_WEIGHTS, DOC_FEATURES), "n_chars"), [])


SQL_METRICS = (f"WITH {_DOC_CTE}\nSELECT {', '.join(_metrics_sql(_pred_sql(), 'n_chars'))} "
               f"FROM prep WHERE is_test")


def q_metrics_by_lang(spark, sf):
    # lang rides along as a pass-through column: no join back to the documents table
    prep = _released(_doc_frame(spark, sf), "n_chars", TEST_SIZE, SEED, DOC_SCALE,
                                   id_columns=["doc_id", "lang"], split_key="doc_id")
    scored = predict(prep.test, PRED_WEIGHTS, DOC_FEATURES)
    return _rounded(evaluate(scored, "n_chars", by=["lang"]), ["lang"])


SQL_METRICS_BY_LANG = (f"WITH {_DOC_CTE}\nSELECT lang, {', '.join(_metrics_sql(_pred_sql(), 'n_chars'))} "
                       f"FROM prep WHERE is_test GROUP BY lang")


def q_r2_constant(spark, sf):
    docs = _doc_frame(spark, sf).select(F.lit(1.0).alias("y"),
                                        (F.col("words") / F.lit(100.0)).alias("prediction"))
    return _rounded(evaluate(docs, "y"), [])


SQL_R2_CONSTANT = (f"WITH d AS (SELECT {_d(1.0)} AS y, {word_count_sql('text')} / {_d(100.0)} AS p FROM documents)\n"
                   f"SELECT {', '.join(_metrics_sql('p', 'y'))} FROM d")


def q_compare(spark, sf):
    prep = _doc_prepared(spark, sf)
    out, _ = compare_models(prep.train, prep.test, DOC_FEATURES, "n_chars", GD_EPOCHS, GD_LR,
                            COMPARE_ALPHA, random_state=SEED, sgd_epochs=SGD_EPOCHS, sgd_batches=SGD_BATCHES,
                            sgd_key=["doc_id"],
                            initial=np.zeros(len(DOC_FEATURES) + 1))
    return _rounded(out, ["model", "implementation"])


def _compare_sql() -> str:
    gd = _gd_cte(DOC_FEATURES, GD_EPOCHS, GD_LR, COMPARE_ALPHA)
    pieces = []
    for label, alpha in (("least_squares", 0.0), ("ridge", COMPARE_ALPHA)):
        a = _d(alpha)
        pieces.append(f"""{label} AS (
  SELECT my - v1 * m1 - v2 * m2 AS w0, v1 AS w1, v2 AS w2 FROM (
    SELECT (a22 * r1 - a12 * r2) / (a11 * a22 - a12 * a12) AS v1,
           (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS v2, m1, m2, my FROM (
      SELECT avg(words) AS m1, avg(lines) AS m2, avg(n_chars) AS my,
        var_pop(words) * count(*) + {a} AS a11, covar_pop(words, lines) * count(*) AS a12,
        var_pop(lines) * count(*) + {a} AS a22, covar_pop(words, n_chars) * count(*) AS r1,
        covar_pop(lines, n_chars) * count(*) AS r2 FROM prep WHERE NOT is_test)))""")
    models = [("Custom GD", "spark_gram", f"(SELECT w0, w1, w2 FROM gd WHERE epoch = {GD_EPOCHS})"),
              ("baseline", "least_squares", "least_squares"), ("baseline", "ridge", "ridge"),
              ("baseline", "sgd_batches", f"(SELECT w0, w1, w2 FROM sgd WHERE step = {SGD_EPOCHS * SGD_BATCHES})")]
    sel = []
    for model, impl, src in models:
        pred = _lincomb_sql(["m.w0", "m.w1", "m.w2"], ["p.words", "p.lines"])
        sel.append(f"SELECT '{model}' AS model, '{impl}' AS implementation, "
                   f"{', '.join(_metrics_sql(pred, 'p.n_chars'))} FROM prep p CROSS JOIN {src} m WHERE p.is_test")
    return (f"WITH RECURSIVE {_DOC_CTE},\n{_doc_train_gram_sql()},\n{gd},\n{_sgd_cte(COMPARE_ALPHA)},\n" + ",\n".join(pieces)
            + "\n" + "\nUNION ALL ".join(sel))


def q_sgd(spark, sf):
    prep = _doc_prepared(spark, sf, _kept)
    try:
        res = fit_sgd(prep.train, DOC_FEATURES, "n_chars", SGD_EPOCHS, GD_LR, 0.0, SEED, SGD_BATCHES, ["doc_id"])
    finally:
        prep.release()
    return _rounded(res.weights_frame(spark), ["idx", "name"])


def _sgd_cte(alpha: float) -> str:
    """Steps over the mini-batches in order, from each mini-batch's sums of products."""
    z = [_d(1.0), *DOC_FEATURES]
    k = len(z)
    sums = [f"sum({z[i]} * {z[j]}) AS g{i}_{j}" for i in range(k) for j in range(i, k)]
    sums += [f"sum({z[i]} * n_chars) AS b{i}" for i in range(k)]
    steps = []
    for i in range(k):
        slope = f"(({' + '.join(f'{_g(i, j)} * w{j}' for j in range(k))}) - b{i}) / n"
        steps.append(f"w{i} - {_d(GD_LR)} * ({slope}{f' + {_d(alpha)} * w{i}' if alpha and i else ''})")
    w = ", ".join(f"w{i}" for i in range(k))
    return f"""mb AS (SELECT CAST({_h52_sql('CAST(doc_id AS VARCHAR)')} % {SGD_BATCHES} AS INTEGER) AS batch, count(*) AS n,
  {', '.join(sums)} FROM prep WHERE NOT is_test GROUP BY 1),
sgd(step, {w}) AS (SELECT 0, {', '.join([_d(0.0)] * k)}
  UNION ALL SELECT step + 1, {', '.join(steps)} FROM sgd JOIN mb ON mb.batch = step % {SGD_BATCHES}
  WHERE step < {SGD_EPOCHS * SGD_BATCHES})"""


def _sgd_sql() -> str:
    names = ["intercept", *DOC_FEATURES]
    sel = "\nUNION ALL ".join(f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')} FROM sgd "
                              f"WHERE step = {SGD_EPOCHS * SGD_BATCHES}" for i in range(len(names)))
    return f"WITH RECURSIVE {_DOC_CTE},\n{_sgd_cte(0.0)}\n{sel}"


SGD_ROW_EPOCHS, SGD_ROW_ALPHA = 2, 0.01


def q_sgd_rows(spark, sf):
    """A step per row, in the order of the key's hash."""
    prep = _doc_prepared(spark, sf, _kept)
    try:
        res = fit_sgd_rows(prep.train, DOC_FEATURES, "n_chars", SGD_ROW_EPOCHS, GD_LR, SGD_ROW_ALPHA, SEED, ["doc_id"])
    finally:
        prep.release()
    return _rounded(res.weights_frame(spark), ["idx", "name"])


def _sgd_rows_sql() -> str:
    e = _lincomb_sql(["w0", "w1", "w2"], DOC_FEATURES) + " - n_chars"
    steps = [f"w0 - {_d(GD_LR)} * ({e})"] + [f"w{j + 1} - {_d(GD_LR)} * (({e}) * {x} + {_d(SGD_ROW_ALPHA)} * w{j + 1})"
                                             for j, x in enumerate(DOC_FEATURES)]
    names = ["intercept", *DOC_FEATURES]
    sel = "\nUNION ALL ".join(f"SELECT {i} AS idx, '{names[i]}' AS name, {_rs(f'w{i}', 'weight')} FROM sgd "
                              "WHERE step = (SELECT max(step) FROM sgd)" for i in range(len(names)))
    return f"""WITH RECURSIVE {_DOC_CTE},
o AS (SELECT row_number() OVER (ORDER BY {_h52_sql('CAST(doc_id AS VARCHAR)')}) - 1 AS place, count(*) OVER () AS n,
  words, lines, n_chars FROM prep WHERE NOT is_test),
sgd(step, w0, w1, w2) AS (SELECT 0::BIGINT, {', '.join([_d(0.0)] * 3)}
  UNION ALL SELECT step + 1, {', '.join(steps)} FROM sgd JOIN o ON o.place = step % o.n WHERE step < {SGD_ROW_EPOCHS} * o.n)
{sel}"""


# ----------------------------------------------------------------------------- R1-R3
def _run_log(spark, sf):
    ev = _read(spark, sf, "events")
    lib = F.col("event_type") == "error"
    procs = (F.when(lib, F.lit(None)).otherwise(
        F.when(F.col("user_id") % 4 == 0, 1).when(F.col("user_id") % 4 == 1, 2)
        .when(F.col("user_id") % 4 == 2, 4).otherwise(8))).cast("bigint")
    return ev.select(F.when(lib, "baseline").otherwise("Custom GD").alias("model"),
                     F.col("event_type").alias("implementation"), procs.alias("processes"),
                     F.col("value").alias("seconds"))


_LOG_CTE = """log AS (SELECT CASE WHEN event_type = 'error' THEN 'baseline' ELSE 'Custom GD' END AS model,
  event_type AS implementation,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(CASE user_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2
       WHEN 2 THEN 4 ELSE 8 END AS BIGINT) END AS processes, value AS seconds FROM events),
st AS (SELECT model, implementation, processes, median(seconds) AS median_time, min(seconds) AS min_time,
  max(seconds) AS max_time, stddev_pop(seconds) AS std_time FROM log GROUP BY model, implementation, processes)"""

_TIME_COLS = ["training_time", "median_time", "min_time", "max_time", "std_time"]


def q_run_stats(spark, sf):
    return _rounded(run_stats(_run_log(spark, sf)), ["model", "implementation", "processes"])


SQL_RUN_STATS = (f"WITH {_LOG_CTE}\nSELECT model, implementation, processes, "
                 f"{_rs('median_time', 'training_time')}, {_rs('median_time', 'median_time')}, "
                 f"{_rs('min_time', 'min_time')}, {_rs('max_time', 'max_time')}, {_rs('std_time', 'std_time')} FROM st")


def _speedup_frame(spark, sf):
    return add_speedup(run_stats(_run_log(spark, sf)), RUN_BASELINE)


def q_speedup(spark, sf):
    return _rounded(_speedup_frame(spark, sf), ["model", "implementation", "processes"])


_SPEEDUP_CTE = f"""{_LOG_CTE},
base AS (SELECT max(median_time) AS bt FROM st WHERE implementation = 'click' AND processes = 1),
sp AS (SELECT st.*, median_time AS training_time,
  CASE WHEN implementation = 'click' AND processes = 1 THEN 1.0 WHEN processes IS NULL THEN NULL
       ELSE bt / median_time END AS speedup,
  CASE WHEN implementation = 'click' AND processes = 1 THEN 1.0 WHEN processes IS NULL THEN NULL
       ELSE bt / median_time / processes END AS efficiency FROM st CROSS JOIN base)"""

SQL_SPEEDUP = (f"WITH {_SPEEDUP_CTE}\nSELECT model, implementation, processes, "
               + ", ".join(_rs(c, c) for c in _TIME_COLS + ["speedup", "efficiency"]) + " FROM sp")


SPEEDUP_BASELINE = {"implementation": "click", "processes": 4}


def q_speedup_base(spark, sf):
    """Against a baseline of four processes."""
    return _rounded(add_speedup(run_stats(_run_log(spark, sf)), SPEEDUP_BASELINE),
                    ["model", "implementation", "processes"])


SQL_SPEEDUP_BASE = f"""WITH {_LOG_CTE},
base AS (SELECT max(median_time) AS bt FROM st WHERE implementation = 'click' AND processes = 4),
sp AS (SELECT st.*, median_time AS training_time, implementation = 'click' AND processes = 4 AS is_base, bt FROM st CROSS JOIN base)
SELECT model, implementation, processes, {', '.join(_rs(c, c) for c in _TIME_COLS)},
  {_rs("CASE WHEN is_base THEN 1.0 WHEN processes IS NULL THEN NULL ELSE bt / median_time END", 'speedup')},
  {_rs("CASE WHEN is_base THEN 1.0 WHEN processes IS NULL THEN NULL ELSE bt / median_time * 4 / processes END", 'efficiency')}
FROM sp"""


def q_report_series(spark, sf):
    return _rounded(report_series(_speedup_frame(spark, sf), "speedup"),
                    ["implementation", "processes", "label", "metric"])


SQL_REPORT_SERIES = (f"WITH {_SPEEDUP_CTE}\nSELECT implementation, processes, "
                     "CASE WHEN processes IS NULL THEN implementation ELSE implementation || ' (' || "
                     "CAST(processes AS VARCHAR) || 'p)' END AS label, 'speedup' AS metric, "
                     f"{_rs('speedup', 'value')} FROM sp WHERE speedup IS NOT NULL AND processes IS NOT NULL")


def q_report_labels(spark, sf):
    """The table behind the training-time bar chart: every run labelled ``impl (kp)``, or
    ``impl`` for the library baselines (processes NULL)."""
    stats = _speedup_frame(spark, sf)
    return _rounded(stats.select(run_label().alias("label"), "training_time"), ["label"])


SQL_REPORT_LABELS = (f"WITH {_SPEEDUP_CTE}\nSELECT CASE WHEN processes IS NULL THEN implementation "
                     "ELSE implementation || ' (' || CAST(processes AS VARCHAR) || 'p)' END AS label, "
                     f"{_rs('training_time', 'training_time')} FROM sp")


# ----------------------------------------------------------------------------- S1-S5
def q_synth(spark, sf):
    orders = _read(spark, sf, "orders")
    frame, _ = synthetic_frame(spark, None, SYNTH_FEATURES, 0.1, SEED, "hash",
                               ids=orders, id_column="o_orderkey")
    return _rounded(frame, ["o_orderkey"])


def _synth_sql() -> str:
    from linfold.sources.synth import true_weights
    w = true_weights(SYNTH_FEATURES, SEED)

    def unit(tag: str, side: str) -> str:
        h = _h52_sql(f"'{tag}'", "CAST(o_orderkey AS VARCHAR)", f"'{side}'")
        return f"((CAST({h} AS DOUBLE) + {_d(0.5)}) / {_d(TWO_POW_52)})"

    def normal(tag: str) -> str:
        return (f"(sqrt({_d(-2.0)} * ln({unit(tag, 'u')})) * "
                f"cos({_d(2.0 * math.pi)} * {unit(tag, 'v')}))")

    xs = [f"x{j + 1}" for j in range(SYNTH_FEATURES)]
    gen = ", ".join(f"{normal(x)} AS {x}" for x in xs)
    y = f"({_lincomb_sql([_d(v) for v in w], xs)} + {normal('noise')} * {_d(0.1)})"
    sel = ", ".join(_rs(x, x) for x in xs)
    return (f"WITH s AS (SELECT o_orderkey, {gen} FROM orders)\n"
            f"SELECT o_orderkey, {sel}, {_rs(y, 'y')} FROM s")


def q_synth_counter(spark, sf):
    """The same shape of data from the keyed counter."""
    orders = _read(spark, sf, "orders")
    frame, _ = synthetic_frame(spark, None, SYNTH_FEATURES, 0.1, SEED, "counter", ids=orders, id_column="o_orderkey")
    return _rounded(frame, ["o_orderkey"])


def _synth_counter_sql() -> str:
    from linfold.sources.synth import GOLDEN, MIX1, MIX2, true_weights
    w = true_weights(SYNTH_FEATURES, SEED)
    whole = "18446744073709551616::UHUGEINT"

    def wrap(expr: str) -> str:
        return f"(({expr}) % {whole})::UBIGINT"

    def times(x: str, by: int) -> str:
        return wrap(f"{x}::UHUGEINT * {by}::UHUGEINT")

    numbers = SYNTH_FEATURES + 1
    units = range(1, 2 * ((numbers + 1) // 2) + 1)
    key = wrap(f"(o_orderkey::UHUGEINT * {GOLDEN}::UHUGEINT) % {whole} + {SEED}::UHUGEINT")
    names = [f"r{u}" for u in units]
    # Three rounds of the mix, for the row and then for each of its numbers.
    stages = [f"k0 AS (SELECT o_orderkey, {key} AS r FROM orders)"]
    stages += [f"k1 AS (SELECT o_orderkey, {times('xor(r, r >> 30)', MIX1)} AS r FROM k0)",
               f"k2 AS (SELECT o_orderkey, {times('xor(r, r >> 27)', MIX2)} AS r FROM k1)",
               "k3 AS (SELECT o_orderkey, xor(r, r >> 31) AS r FROM k2)"]
    starts = ", ".join(f"{wrap(f'r::UHUGEINT + {u * GOLDEN % 2**64}::UHUGEINT')} AS r{u}" for u in units)
    stages.append(f"n0 AS (SELECT o_orderkey, {starts} FROM k3)")
    for at, (shift, by) in enumerate(((30, MIX1), (27, MIX2))):
        parts = ", ".join(f"{times(f'xor({r}, {r} >> {shift})', by)} AS {r}" for r in names)
        stages.append(f"n{at + 1} AS (SELECT o_orderkey, {parts} FROM n{at})")
    parts = ", ".join(f"((xor({r}, {r} >> 31) >> 12)::DOUBLE + {_d(0.5)}) / {_d(TWO_POW_52)} AS {r}" for r in names)
    stages.append(f"u AS (SELECT o_orderkey, {parts} FROM n2)")
    normal = [f"sqrt({_d(-2.0)} * ln(r{2 * (j // 2) + 1})) * {'cos' if j % 2 == 0 else 'sin'}({_d(2.0 * math.pi)} * r{2 * (j // 2) + 2})"
              for j in range(numbers)]
    xs = [f"x{j + 1}" for j in range(SYNTH_FEATURES)]
    stages.append(f"s AS (SELECT o_orderkey, {', '.join(f'{v} AS {x}' for v, x in zip(normal, [*xs, 'e']))} FROM u)")
    y = f"({_lincomb_sql([_d(v) for v in w], xs)} + e * {_d(0.1)})"
    return "WITH " + ",\n".join(stages) + f"\nSELECT o_orderkey, {', '.join(_rs(x, x) for x in xs)}, {_rs(y, 'y')} FROM s"


def _roundtrip(fmt):
    def run(spark, sf):
        part = _read(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                               "p_size", "p_retailprice")
        path = write_table(part, scratch_path(spark, f"roundtrip-{fmt}"), fmt)
        back = load_table(spark, path, fmt)
        return back.select("p_partkey", "p_name", "p_brand", "p_type",
                           F.col("p_size").cast("bigint").alias("p_size"),
                           F.col("p_retailprice").cast("double").alias("p_retailprice"))
    return run


def q_csv_text(spark, sf):
    """Texts with quotes, commas, padding and line ends, written as CSV and read back."""
    docs = _awkward_texts(_read(spark, sf, "documents"))
    path = write_table(docs, scratch_path(spark, "csv-text"), "csv")
    return load_table(spark, path, "csv", multi_line=True)


def _awkward_texts(docs):
    text = F.concat(F.lit(' say "hi", '), F.regexp_replace("text", "\r", " "), F.lit(', ""end"" '))
    return docs.select("doc_id", text.alias("text"), "lang")


SQL_CSV_TEXT = """SELECT doc_id, ' say "hi", ' || replace(text, chr(13), ' ') || ', ""end"" ' AS text, lang FROM documents"""


def q_csv_na_tokens(spark, sf):
    """S1 with pandas NA semantics: a CSV whose missing values are written as ``NA`` is read
    back with NULLs and numeric types (integers stay integers, a column with NA stays
    numeric)."""
    cust = _read(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey",
        F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment")
    path = scratch_path(spark, "na-tokens")
    cust.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)
    back = load_table(spark, path, "csv")
    assert dict(back.dtypes) == {"c_custkey": "bigint", "c_name": "string",
                                 "c_nationkey": "bigint", "c_acctbal": "double",
                                 "c_mktsegment": "string"}, back.dtypes
    return back


SQL_CSV_NA_TOKENS = """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer"""


SQL_ROUNDTRIP = ("SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, "
                 "p_retailprice FROM part")


def q_save_splits(spark, sf):
    prep = _doc_prepared(spark, sf)
    train_path, test_path = save_processed_splits(prep, scratch_path(spark, "splits"), fmt="csv")
    train = load_table(spark, train_path, "csv").withColumn("split", F.lit("train"))
    test = load_table(spark, test_path, "csv").withColumn("split", F.lit("test"))
    return _rounded(train.unionByName(test), ["split"])


SQL_SAVE_SPLITS = (f"WITH {_DOC_CTE}\nSELECT {_rs('words', 'words')}, {_rs('lines', 'lines')}, "
                   f"{_rs('n_chars', 'n_chars')}, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM prep")


def _results_roundtrip(fmt):
    def run(spark, sf):
        path = write_results(_speedup_frame(spark, sf), scratch_path(spark, f"results-{fmt}"), fmt)
        back = load_table(spark, path, fmt)
        cols = [F.col(c) for c in ("model", "implementation")]
        cols.append(F.col("processes").cast("bigint").alias("processes"))
        cols += [round_sig(F.col(c).cast("double")).alias(c)
                 for c in _TIME_COLS + ["speedup", "efficiency"]]
        return back.select(*cols)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q_target_scale": q_target_scale,
        "q_split_hash": q_split_hash,
        "q_split_exact": q_split_exact,
        "q_layout": q_layout,
        "q_chunk_gradients": q_chunk_gradients,
        "q_gradient_null": q_gradient_null,
        "q_onehot_many": q_onehot_many,
        "q_gram_wide": q_gram_wide,
        "q_gd_per_epoch": q_gd_per_epoch,
        "q_gd_seeded": q_gd_seeded,
        "q_ols_scales": q_ols_scales,
        "q_ols_collinear": q_ols_collinear,
        "q_category_transform": q_category_transform,
        "q_category_ridge": q_category_ridge,
        "q_speedup_base": q_speedup_base,
        "q_csv_text": q_csv_text,
        "q_prepare_exact": q_prepare_exact,
        "q_vector": q_vector,
        "q_impute_median": q_impute_median,
        "q_scale": q_scale,
        "q_impute_mode": q_impute_mode,
        "q_onehot": q_onehot,
        "q_preprocess": q_preprocess,
        "q_prepare": q_prepare,
        "q_gram": q_gram,
        "q_gram_onehot": q_gram_onehot,
        "q_gradient": _q_gradient(0.0),
        "q_gradient_ridge": _q_gradient(GRAD_ALPHA),
        "q_loss": q_loss,
        "q_gd_weights": q_gd_weights,
        "q_gd_history": q_gd_history,
        "q_gd_early_stop": q_gd_early_stop,
        "q_predict": q_predict,
        "q_predict_onehot": q_predict_onehot,
        "q_gd_onehot": q_gd_onehot,
        "q_ols": q_ols,
        "q_ridge": q_ridge,
        "q_metrics": q_metrics,
        "q_metrics_by_lang": q_metrics_by_lang,
        "q_r2_constant": q_r2_constant,
        "q_compare": q_compare,
        "q_sgd": q_sgd,
        "q_sgd_rows": q_sgd_rows,
        "q_run_stats": q_run_stats,
        "q_speedup": q_speedup,
        "q_report_series": q_report_series,
        "q_report_labels": q_report_labels,
        "q_synth": q_synth,
        "q_synth_counter": q_synth_counter,
        "q_roundtrip_csv": _roundtrip("csv"),
        "q_roundtrip_json": _roundtrip("json"),
        "q_csv_na_tokens": q_csv_na_tokens,
        "q_save_splits": q_save_splits,
        "q_results_csv": _results_roundtrip("csv"),
        "q_results_json": _results_roundtrip("json"),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "q_target_scale": SQL_TARGET_SCALE,
        "q_split_hash": SQL_SPLIT_HASH,
        "q_split_exact": SQL_SPLIT_EXACT,
        "q_layout": _gradient_sql(0.0, partitions=True),
        "q_chunk_gradients": _chunk_gradients_sql(),
        "q_gradient_null": _gradient_sql(0.0, where=" WHERE l_orderkey % 7 > 0 AND l_orderkey % 11 > 0 AND l_orderkey % 13 > 0"),
        "q_onehot_many": SQL_ONEHOT_MANY,
        "q_gram_wide": SQL_GRAM_WIDE,
        "q_gd_per_epoch": _gd_variant_sql(PER_EPOCH_EPOCHS, 0.1, GRAD_ALPHA),
        "q_gd_seeded": _gd_variant_sql(SEEDED_EPOCHS, GD_LR, 0.0, initial_weights(len(DOC_FEATURES), SEED)),
        "q_ols_scales": SQL_OLS_SCALES,
        "q_ols_collinear": SQL_OLS_COLLINEAR,
        "q_category_transform": SQL_CATEGORY_TRANSFORM,
        "q_category_ridge": SQL_CATEGORY_RIDGE,
        "q_speedup_base": SQL_SPEEDUP_BASE,
        "q_csv_text": SQL_CSV_TEXT,
        "q_prepare_exact": SQL_PREPARE_EXACT,
        "q_vector": _vector_sql(),
        "q_sgd": _sgd_sql(),
        "q_sgd_rows": _sgd_rows_sql(),
        "q_impute_median": SQL_IMPUTE_MEDIAN,
        "q_scale": _scale_sql(),
        "q_impute_mode": SQL_IMPUTE_MODE,
        "q_onehot": SQL_ONEHOT,
        "q_preprocess": _preprocess_sql(),
        "q_prepare": SQL_PREPARE,
        "q_gram": _gram_sql(),
        "q_gram_onehot": _gram_onehot_sql(),
        "q_gradient": _gradient_sql(0.0),
        "q_gradient_ridge": _gradient_sql(GRAD_ALPHA),
        "q_loss": _loss_query_sql(),
        "q_gd_weights": _gd_weights_sql(),
        "q_gd_history": _gd_history_sql(),
        "q_gd_early_stop": _gd_early_stop_sql(),
        "q_predict": SQL_PREDICT,
        "q_predict_onehot": SQL_PREDICT_ONEHOT,
        "q_gd_onehot": _gd_onehot_sql(),
        "q_ols": SQL_OLS,
        "q_ridge": SQL_RIDGE,
        "q_metrics": SQL_METRICS,
        "q_metrics_by_lang": SQL_METRICS_BY_LANG,
        "q_r2_constant": SQL_R2_CONSTANT,
        "q_compare": _compare_sql(),
        "q_run_stats": SQL_RUN_STATS,
        "q_speedup": SQL_SPEEDUP,
        "q_report_series": SQL_REPORT_SERIES,
        "q_report_labels": SQL_REPORT_LABELS,
        "q_synth": _synth_sql(),
        "q_synth_counter": _synth_counter_sql(),
        "q_roundtrip_csv": SQL_ROUNDTRIP,
        "q_roundtrip_json": SQL_ROUNDTRIP,
        "q_csv_na_tokens": SQL_CSV_NA_TOKENS,
        "q_save_splits": SQL_SAVE_SPLITS,
        "q_results_csv": SQL_SPEEDUP,
        "q_results_json": SQL_SPEEDUP,
    }
