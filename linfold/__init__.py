"""linfold: linear-regression pipelines on Spark DataFrames.

Read -> split -> leakage-safe preprocessing -> gradient descent on distributed sufficient
statistics -> OLS / ridge / SGD baselines -> metrics -> run reports.
"""

from linfold.operators.categories import CategoryModel, CategoryWeights, NormalEquations
from linfold.operators.compare import compare_models
from linfold.operators.gd import TrainingResult, fit_gd, initial_weights, predict
from linfold.operators.gram import (GramStats, chunk_gradients, combine_chunks, compute_gradient, compute_loss, gradient_frame,
                                    gradient_partials, gram_stats, gram_sums_frame, loss_frame)
from linfold.operators.linear import LinearModel, fit_ols, fit_ridge, solve_centred
from linfold.operators.metrics import evaluate, evaluate_many, evaluate_model
from linfold.operators.prepare import PreparedData, prepare_train_test_data
from linfold.operators.preprocess import Preprocessor, PreprocessorModel, build_preprocessor
from linfold.operators.runlog import add_speedup, loss_history_frame, report_series, run_stats
from linfold.operators.select import exact_quantiles, kth_smallest
from linfold.operators.sgd import fit_sgd, fit_sgd_rows
from linfold.operators.split import chunk_of, split_flag, train_test_split
from linfold.operators.target import TARGET_SCALE, feature_types, split_target
from linfold.session import checkpoint_dir, get_spark
from linfold.sources.io import load_table, save_processed_splits, write_results
from linfold.sources.synth import make_synthetic_regression

__all__ = [
    "TARGET_SCALE", "CategoryModel", "CategoryWeights", "GramStats", "NormalEquations", "LinearModel", "PreparedData", "Preprocessor",
    "PreprocessorModel", "TrainingResult", "add_speedup", "build_preprocessor", "checkpoint_dir",
    "chunk_gradients", "chunk_of", "combine_chunks", "compare_models", "compute_gradient", "compute_loss", "evaluate", "evaluate_many",
    "evaluate_model", "exact_quantiles", "feature_types", "fit_gd", "fit_ols", "fit_ridge",
    "fit_sgd", "fit_sgd_rows", "get_spark", "gradient_frame", "gradient_partials", "gram_stats", "gram_sums_frame",
    "initial_weights", "kth_smallest", "load_table", "loss_frame", "loss_history_frame",
    "make_synthetic_regression", "predict", "prepare_train_test_data", "report_series",
    "run_stats", "save_processed_splits", "solve_centred", "split_flag", "split_target",
    "train_test_split", "write_results",
]
