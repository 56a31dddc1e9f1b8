"""Benchmark: the reference's workloads as Spark jobs, timed at ``$BENCH_SF_DIR``.

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries": {...}, "sf"}.
passes on lineitem, the whole experiment (1000 epochs), the quick check (20 epochs) and the whole
synthetic load (1 000 000 x 20, 500 epochs), each over 1, 2, 4, 8 tasks (quick check: 1, 2) with
repeats and all baselines, SGD passes included, and every registered query of the catalog.
``$BENCH_REPEATS`` (5) sets the repeats of the two whole workloads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel  # noqa: E402

from linfold.operators.compare import compare_models  # noqa: E402
from linfold.operators.gd import fit_gd, predict  # noqa: E402
from linfold.operators.gram import gram_stats  # noqa: E402
from linfold.operators.linear import solve_centred  # noqa: E402
from linfold.operators.metrics import evaluate_model  # noqa: E402
from linfold.operators.prepare import prepare_train_test_data  # noqa: E402
from linfold.operators.sgd import fit_sgd  # noqa: E402
from linfold.plans import catalog  # noqa: E402
from linfold.plans.jobs import run_suite  # noqa: E402
from linfold.session import get_spark  # noqa: E402
from linfold.sources.synth import make_synthetic_regression  # noqa: E402


def _timed(results: dict, name: str, fn):
    t0 = time.perf_counter()
    out = fn()
    results[name] = round(time.perf_counter() - t0, 3)
    return out


def _drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", "linfold-bench", {
        "spark.sql.shuffle.partitions": str(max(8, int(cpus))),
        "spark.driver.memory": "16g",
    })
    q: dict[str, float] = {}
    # untimed JVM warm-up so the first workload is not charged with class loading / JIT:
    # codegen'd aggregation, a Parquet scan with a regex, a persisted frame
    spark.range(0, 1_000_000, 1, int(cpus)).selectExpr("sum(id * 2)").collect()
    warm = spark.read.parquet(f"{sf_dir}/region.parquet").selectExpr(
        "regexp_count(r_name, '\\\\S+') AS w", "md5(r_name) AS h").persist()
    warm.groupBy("h").count().collect()
    warm.unpersist()

    # --- experiment workload on documents: prepare -> GD 1000 epochs -> baselines -> metrics
    prep = _timed(q, "prepare_documents", lambda: catalog._doc_prepared(spark, sf_dir))
    train = prep.train.persist(StorageLevel.MEMORY_AND_DISK)
    _timed(q, "gd_documents_1000ep", lambda: fit_gd(
        train, prep.feature_names, "n_chars", epochs=1000, learning_rate=0.01, random_state=42))
    _timed(q, "compare_documents", lambda: compare_models(
        train, prep.test, prep.feature_names, "n_chars", 1000, 0.01, 0.0, 42,
        include_sgd=False)[0].collect())
    _timed(q, "sgd_documents_20ep", lambda: fit_sgd(
        train, prep.feature_names, "n_chars", 20, 0.01, 0.0, 42))
    train.unpersist()
    prep.release()

    # --- one-hot design (part: 25 brands + 6 types): prepare, then GD on grouped counts
    part_prep = _timed(q, "prepare_part_onehot", lambda: prepare_train_test_data(
        spark.read.parquet(f"{sf_dir}/part.parquet").drop("p_name"), "p_retailprice", 0.2, 42,
        1000.0, id_columns=["p_partkey"]))
    _timed(q, "gd_part_onehot_1000ep", lambda: part_prep.fit_gd(
        epochs=1000, learning_rate=0.01, random_state=42))
    part_prep.release()

    # --- load workload on lineitem: Gram pass, GD 1000 epochs, per-epoch passes
    li = catalog._li_frame(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    _timed(q, "gram_lineitem", lambda: gram_stats(li, catalog.LI_FEATURES, "y"))
    _timed(q, "gd_lineitem_1000ep", lambda: fit_gd(
        li, catalog.LI_FEATURES, "y", epochs=1000, learning_rate=0.001, random_state=42))
    _timed(q, "gd_lineitem_per_epoch_20ep", lambda: fit_gd(
        li, catalog.LI_FEATURES, "y", epochs=20, learning_rate=0.001, random_state=42,
        solver="per_epoch"))
    li.unpersist()

    #     reference's load workload: 500 epochs, OLS, evaluation on test
    feats = [f"x{j + 1}" for j in range(20)]
    holder = {}

    def generate():
        tr, te, _ = make_synthetic_regression(spark, 1_000_000, 20, method="randn",
                                              num_partitions=int(cpus))
        holder["train"], holder["test"] = tr.persist(StorageLevel.MEMORY_AND_DISK), te
        holder["train"].count()
    _timed(q, "synth_1m_x20_generate_and_cache", generate)
    tr = holder["train"]
    _timed(q, "synth_1m_x20_gram_first", lambda: gram_stats(tr, feats, "y"))
    st = _timed(q, "synth_1m_x20_gram_second", lambda: gram_stats(tr, feats, "y"))
    _timed(q, "synth_1m_x20_per_epoch_1ep", lambda: fit_gd(
        tr, feats, "y", epochs=1, learning_rate=0.01, random_state=42, solver="per_epoch"))
    _timed(q, "synth_1m_x20_per_epoch_10ep", lambda: fit_gd(
        tr, feats, "y", epochs=10, learning_rate=0.01, random_state=42, solver="per_epoch"))

    def load():
        res = fit_gd(tr, feats, "y", epochs=500, learning_rate=0.01, random_state=42, stats=st)
        solve_centred(st)
        return evaluate_model(predict(holder["test"], res.weights, feats), "y")
    _timed(q, "synth_1m_x20_gd500_ols_eval", load)

    repeats = int(os.environ.get("BENCH_REPEATS", "5"))

    def suite(train, test, names, target, epochs, tasks, times):
        return run_suite(spark, train, test, names, target, epochs=epochs, learning_rate=0.01,
                         partitions=tasks, repeats=times)[0].collect()
    _timed(q, "synthetic_load_full", lambda: suite(tr, holder["test"], feats, "y", 500, [1, 2, 4, 8], repeats))
    tr.unpersist()

    # --- the experiment: quick check, then whole
    def experiment(epochs, tasks, times):
        prep = catalog._doc_prepared(spark, sf_dir)
        return suite(prep.train, prep.test, prep.feature_names, "n_chars", epochs, tasks, times)
    _timed(q, "experiment_quick_check", lambda: experiment(20, [1, 2], 2))
    _timed(q, "experiment_full", lambda: experiment(1000, [1, 2, 4, 8], repeats))

    # --- every registered query, drained without collecting to the driver
    for name, fn in catalog.queries().items():
        spark.catalog.clearCache()   # no query reads what an earlier one kept
        _timed(q, name, lambda fn=fn: _drain(fn(spark, sf_dir)))

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(q.values()), 3),
                      "unit": "sec", "queries": q, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
