"""Prepare train/test data (E7): load -> target -> split -> fit on train -> transform both.

Statistics are eager (three small aggregate jobs on the persisted raw train split); both
outputs stay lazy DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from linfold.operators.preprocess import Preprocessor, PreprocessorModel
from linfold.operators.split import train_test_split
from linfold.operators.target import TARGET_SCALE, check_targets, split_target
from linfold.session import materialize as keep_for_passes


@dataclass(frozen=True)
class PreparedData:
    train: DataFrame            # id columns, feature columns, target (scaled)
    test: DataFrame
    preprocessor: PreprocessorModel
    feature_names: list[str]
    target_column: str
    target_scale: float
    id_columns: tuple[str, ...] = ()
    kept: DataFrame | None = None   # the materialized raw train split behind `train`
    raw_test: DataFrame | None = None

    def fit_gd(self, **kwargs):
        """Gradient descent on the train split. With one-hot columns the Gram statistics and
        the residual passes come from grouped aggregates of the raw columns, so the cost
        does not grow with the number of categories."""
        from linfold.operators.gd import fit_gd
        from linfold.operators.gram_onehot import onehot_partials
        if self.preprocessor.categorical and self.kept is not None:
            if kwargs.get("solver", "gram") == "gram" and kwargs.get("stats") is None:
                kwargs["stats"] = self.gram_stats()
            kwargs.setdefault("partials", lambda w: onehot_partials(
                self.kept, self.preprocessor, self.target_column, w))
        return fit_gd(self.train, self.feature_names, self.target_column, **kwargs)

    def prediction_column(self, weights, on: str = "test"):
        """Predictions as a column of ``raw_test`` (``on="test"``) or of the kept raw train."""
        frame = self.raw_test if on == "test" else self.kept
        return self.preprocessor.prediction_column(weights, frame.schema)

    def gram_stats(self):
        """Gram statistics of the prepared train split computed from grouped counts of the
        raw columns (cost independent of the number of one-hot categories)."""
        from linfold.operators.gram_onehot import onehot_gram_stats
        if self.kept is None:
            raise ValueError("the raw train split is not kept")
        return onehot_gram_stats(self.kept, self.preprocessor, self.target_column)

    def release(self) -> None:
        """Drop the cached raw train split once training is done."""
        if self.kept is not None and self.kept.is_cached:
            self.kept.unpersist()


def prepare_train_test_data(source: str | DataFrame, target_column: str = "median_house_value",
                            test_size: float = 0.2, random_state: int = 42,
                            target_scale: float = TARGET_SCALE, spark: SparkSession | None = None,
                            id_columns: tuple[str, ...] | list[str] = (),
                            split_key: str | list[str] | None = None, split_mode: str = "exact",
                            max_categories: int | None = None,
                            materialize: str = "persist",
                            split_hash: str = "md5", median: str = "exact") -> PreparedData:
    """A table read, split and preprocessed; every fitted statistic comes from train rows alone.

    ``split_key`` defaults to the id columns, or to every column when there are none. Rows without
    a target and empty splits are errors. ``split_mode``: ``exact`` (test holds ceil(test_size * n)
    rows) or ``hash`` (about as many, by one filter).
    ``materialize`` keeps the raw train split for the fit passes and the training that
    follows: ``persist`` (cache) or ``checkpoint`` (shared folder, lineage cut).
    """
    if isinstance(source, DataFrame):
        df = source
    else:
        from linfold.sources.io import load_table
        if spark is None:
            spark = SparkSession.getActiveSession()
        if spark is None:
            raise ValueError("A SparkSession is required to read a path.")
        df = load_table(spark, source)
    frame, features = split_target(df, target_column, target_scale, id_columns)
    key = split_key if split_key is not None else (list(id_columns) or None)
    raw_train, raw_test = train_test_split(frame, test_size, random_state, key=key,
                                           mode=split_mode, algorithm=split_hash)
    raw_train = keep_for_passes(raw_train, materialize)
    check_targets(raw_train, raw_test, target_column)
    model = Preprocessor(features, max_categories, median).fit(raw_train)
    keep = list(id_columns) + [target_column]
    train = model.transform(raw_train, keep)
    test = model.transform(raw_test, keep)
    return PreparedData(train, test, model, model.feature_names, target_column, target_scale,
                        tuple(id_columns), raw_train, raw_test)
