"""Print the physical plans of the hot passes (evidence for pruning, pushdown, codegen,
partial aggregation). Usage: python tools/explain_plans.py [sf_dir] > docs/PLANS.md"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from linfold.functions.exprs import word_count  # noqa: E402
from linfold.operators.gram import _partial_columns  # noqa: E402
from linfold.operators.metrics import evaluate_many  # noqa: E402
from linfold.operators.preprocess import Preprocessor  # noqa: E402
from linfold.operators.split import hash_test_flag  # noqa: E402
from linfold.plans import catalog  # noqa: E402
from linfold.session import get_spark  # noqa: E402


WIDTH = 150   # the operators and the start of their arguments


def show(title, df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    lines = [line[:WIDTH] for line in buf.getvalue().strip().splitlines()[1:] if "Physical Plan" not in line]
    print(f"## {title}\n\n```\n" + "\n".join(lines) + "\n```\n")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    li = catalog._li_frame(spark, sf)
    print(f"# Physical plans of the hot passes ({os.path.basename(sf)})\n")
    feats = catalog.LI_FEATURES
    z = [F.col(c) - F.lit(1.0) for c in feats + ["y"]]
    cols = feats + ["y"]
    show("Gram statistics, d <= 5 (avg / covar_pop, no shift row): one partial/final aggregate",
         li.agg(F.count(F.lit(1)), *[F.avg(c) for c in cols],
                *[F.covar_pop(cols[i], cols[j]) for i in range(4) for j in range(i, 4)]))
    show("Gram statistics, d 6-8 form (sums shifted by a sample row): one partial/final aggregate",
         li.agg(F.count(F.lit(1)), *[F.sum(z[i] * z[j]) for i in range(4) for j in range(i, 4)]))
    show("Gradient partials at fixed weights (chunk gradient + row-weighted combine)",
         li.agg(*_partial_columns(feats, "y", np.array([0.1, 0.01, -0.5, 0.3]))))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    train = docs.filter(~hash_test_flag(42, ["doc_id"], 0.2)).select(
        "doc_id", word_count("text").alias("words"), "lang", "n_chars")
    show("Hash split + word count (narrow, codegen'd, no shuffle)", train)
    stacked = train.select(F.explode(F.array(F.struct(F.lit(0).alias("c"), F.col("lang").alias("v"))))
                           .alias("e")).filter(F.col("e.v").isNotNull())
    show("Mode / category fit: stacked groupBy(column, value) with map-side combine",
         stacked.groupBy(F.col("e.c"), F.col("e.v")).count())
    model = Preprocessor(["words", "lang"]).fit(train)
    out = model.transform(docs.select("doc_id", word_count("text").alias("words"), "lang", "n_chars"),
                          ["doc_id", "n_chars"])
    show("Preprocessor transform: one fused projection", out)
    preds = {"a": F.lit(1.0) + F.col("words") * 0.5, "b": F.lit(2.0) + F.col("words") * 0.1}
    show("All models scored in one scan, metrics in one aggregate",
         evaluate_many(out, "n_chars", preds))

    # internal passes: record the plan of every DataFrame the operators collect
    from linfold.operators.prepare import prepare_train_test_data
    DataFrame = type(li)          # the concrete (classic) DataFrame class
    from linfold.operators.select import exact_quantiles
    recorded = []
    original = DataFrame.collect

    def recording(self):
        recorded.append(self)
        return original(self)

    DataFrame.collect = recording
    try:
        exact_quantiles(li, ["y", "l_quantity"], 0.5)
        steps = list(recorded)
        recorded.clear()
        prep = prepare_train_test_data(docs.select("doc_id", word_count("text").alias("words"),
                                                   "lang", "n_chars"),
                                       "n_chars", 0.2, 42, 1000.0, id_columns=["doc_id"])
        recorded.clear()
        prep.gram_stats()
        gram_steps = list(recorded)
    finally:
        DataFrame.collect = original
    for i, df in enumerate(steps):
        show(f"Exact median, pass {i + 1} of {len(steps)} (lineitem)", df)
    for i, df in enumerate(gram_steps):
        show(f"One-hot aware Gram, collected step {i + 1} of {len(gram_steps)} (documents, lang)", df)


if __name__ == "__main__":
    main()
