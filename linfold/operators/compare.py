"""Model comparison (B4): gradient descent against OLS, ridge and SGD on one split.

OLS and ridge share one QR factor (given Gram statistics, these); all models are scored on ``test`` in ONE
scan (predictions are columns of the same projection) and all metrics come from ONE
aggregate, stacked to one row per model.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.functions.exprs import quote
from linfold.operators.gd import fit_gd, prediction_column
from linfold.operators.gram import gram_stats
from linfold.operators.linear import fit_ols, fit_ridge, solve_centred
from linfold.operators.metrics import evaluate_many
from linfold.operators.qr import r_factor
from linfold.operators.sgd import fit_sgd, fit_sgd_rows

GD_MODEL = ("Custom GD", "spark_gram")
OLS_MODEL = ("baseline", "least_squares")
RIDGE_MODEL = ("baseline", "ridge")
SGD_MODEL = ("baseline", "sgd_rows")
SGD_BATCH_MODEL = ("baseline", "sgd_batches")


def compare_models(train: DataFrame, test: DataFrame, features: list[str], target: str,
                   epochs: int = 1000, learning_rate: float = 0.01, alpha: float = 0.0,
                   random_state: int | None = 42, early_stopping: bool = False,
                   tol: float = 1e-6, patience: int = 20, include_baselines: bool = True,
                   include_sgd: bool = True, sgd_epochs: int | None = None, sgd_batches: int | None = None,
                   sgd_key: list[str] | None = None, initial=None, stats=None):
    """Returns ``(metrics_frame, models)``; the frame has one row per model with
    ``model, implementation, MSE, RMSE, MAE, R2``. ``sgd_key``: columns whose
    hash orders the rows for SGD (with ``sgd_batches``: deals them to so many mini-batches). ``stats``: precomputed Gram statistics
    of ``train`` (e.g. ``PreparedData.gram_stats()``, one-hot aware)."""
    features = list(features)
    kept = dict.fromkeys([*features, target, *(sgd_key or [])])
    cached = train.select(*[F.col(quote(c)) for c in kept]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        given = stats
        stats = stats or gram_stats(cached, features, target)
        models = {GD_MODEL: fit_gd(cached, features, target, epochs, learning_rate, alpha,
                                   random_state, early_stopping, tol, patience,
                                   initial=initial, stats=stats).weights}
        if include_baselines:
            # as in the reference, the ridge baseline takes the same alpha on its own
            # (SSE) scale; it equals the GD objective only at alpha_gd = alpha / n
            if given is not None:
                models[OLS_MODEL] = solve_centred(given, 0.0).weights
                models[RIDGE_MODEL] = solve_centred(given, alpha).weights
            else:
                factor = r_factor(cached, features, target)
                models[OLS_MODEL] = fit_ols(cached, features, target, factor).weights
                models[RIDGE_MODEL] = fit_ridge(cached, features, target, alpha, factor).weights
            if include_sgd:
                steps = (cached, features, target, sgd_epochs or epochs, learning_rate, alpha, random_state or 0)
                if sgd_batches is None:
                    models[SGD_MODEL] = fit_sgd_rows(*steps, sgd_key).weights
                else:
                    models[SGD_BATCH_MODEL] = fit_sgd(*steps, sgd_batches, sgd_key).weights
    finally:
        cached.unpersist()
    preds = {f"{m}|{i}": prediction_column(w, features) for (m, i), w in models.items()}
    metrics = evaluate_many(test, target, preds)
    name = F.split(F.col("name"), r"\|")
    out = metrics.select(name[0].alias("model"), name[1].alias("implementation"),
                         "MSE", "RMSE", "MAE", "R2")
    return out, models
