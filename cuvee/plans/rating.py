"""The whole job: prepare, train, featurize, evaluate. Steps hand over stored tables and saved models."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.functions.text import content_words
from cuvee.operators import evaluate
from cuvee.operators.assemble import (
    FeatureSettings,
    apply_features,
    count_terms,
    feature_dictionary,
    fit_features,
    store_features,
    topic_terms,
)
from cuvee.operators.clean import clean_titles, normalize_categories
from cuvee.operators.forest import (
    FOREST_VALUES,
    Elimination,
    eliminate,
    eliminate_by_validation,
    forest,
    search,
    top_features,
    words_of_top_topics,
)
from cuvee.operators.profile import histogram
from cuvee.operators.split import keys_of, kfold, with_position
from cuvee.operators.text import join_stems
from cuvee.runtime import discard, materialize
from cuvee.schema import KEY
from cuvee.sources.features import (
    read_features,
    write_feature_dictionary,
    write_features,
    write_search_results,
)
from cuvee.sources.reviews import read_split, write_split


def clean(raw: DataFrame) -> DataFrame:
    """Cleaned reviews: the raw columns in normal form, plus ``year``. Every row of ``raw`` gives one row."""
    fields = clean_titles(normalize_categories(raw))
    worded = fields.withColumn("_words", content_words(F.col("description"))).drop("description")
    return join_stems(worded).withColumnRenamed("_text", "description")


def prepare(raw: DataFrame, path: str, test_size: float = 0.2) -> None:
    """Clean, number and split the reviews, and store both sets.

    Ids that aren't 0 .. n - 1, each once, are replaced by the place in their order, so that later steps find contiguous ids that
    are unique; ``original_id`` keeps what they were. The count and the order are taken from the ids of the raw rows.
    """
    keys = keys_of(raw.select(KEY))
    cleaned = clean(raw).withColumn("original_id", F.col(KEY))
    if not keys.contiguous:
        # Read more than once for the places, so it is stored.
        cleaned = with_position(materialize(cleaned.drop(KEY), "cleaned"), "original_id", KEY)
    split = F.when(F.col(KEY) < int(keys.n * test_size), "test").otherwise("train")
    write_split(cleaned.withColumn("split", split), path)


@dataclass
class TrainedRating:
    """Fitted features and the pruned regressor, saved and loaded separately."""

    features: PipelineModel
    elimination: Elimination
    settings: FeatureSettings
    results: DataFrame | None = None
    #: (fold, n_features, mse) of the elimination by validation.
    scores: DataFrame | None = None

    def save(self, path: str) -> None:
        self.features.write().overwrite().save(os.path.join(path, "features"))
        self.elimination.model.write().overwrite().save(os.path.join(path, "regressor"))
        support = self.elimination.support(SparkSession.getActiveSession())
        support.write.mode("overwrite").parquet(os.path.join(path, "support"))
        if self.scores is not None:
            self.scores.write.mode("overwrite").parquet(os.path.join(path, "elimination_scores"))
        if self.results is not None:
            write_search_results(self.results, os.path.join(path, "search_results"))


def load_models(path: str) -> tuple[PipelineModel, PipelineModel]:
    return (
        PipelineModel.load(os.path.join(path, "features")),
        PipelineModel.load(os.path.join(path, "regressor")),
    )


def train(
    train_set: DataFrame,
    settings: FeatureSettings | None = None,
    select_model: bool = False,
    n_iter: int = 100,
    keep: int = 29,
    step: float = 10,
    folds: int = 5,
    trees: int = 300,
    depth: int | None = None,
    seed: int = 0,
    space: dict | None = None,
    partitions: int | None = None,
    max_bins: int = 32,
    memory_mb: int = 256,
    ledger: str | None = None,
) -> TrainedRating:
    """Fixed parameters and elimination to ``keep`` features, or a search and elimination by validation.

    Forests have exact splits and no limit of depth. With a ``depth`` they are binned ones; ``partitions`` is how many parts these are fitted on
    (by the number of rows, unless given), ``memory_mb`` what one pass of a fit may hold per task. ``ledger`` is a shared folder in which
    finished fits of the search and of the elimination are noted; a run with the same rows and parameters goes on from there.
    """
    settings = settings or FeatureSettings(seed=seed)
    chosen: dict = {"trees": trees}
    results = None
    if select_model:
        results, best = search(train_set, settings, space, n_iter, folds, depth, seed, partitions=partitions, ledger=ledger)
        settings = settings.with_values({k: v for k, v in best.items() if k not in FOREST_VALUES})
        chosen.update({k: v for k, v in best.items() if k in FOREST_VALUES})
    counted = materialize(count_terms(train_set, settings).drop(*settings.roles.text), "train")
    features = fit_features(counted, settings)
    matrix = store_features(features, counted, settings)
    discard(counted)
    regressor = forest(**chosen, depth=depth, seed=seed, max_bins=max_bins, memory_mb=memory_mb)
    scores = None
    if select_model:
        folded = materialize(kfold(matrix, folds), "folded")
        elimination, scores = eliminate_by_validation(folded, regressor, folds, step, partitions, ledger)
    else:
        elimination = eliminate(matrix, regressor, keep, step, partitions=partitions, ledger=ledger)
    return TrainedRating(features, elimination, settings, results, scores)


def featurize(features: PipelineModel, split: DataFrame, settings: FeatureSettings, path: str) -> None:
    """Feature matrix and outcome of one split, with what the positions mean."""
    write_features(apply_features(features, split, settings), os.path.join(path, "matrix"))
    write_feature_dictionary(feature_dictionary(features), topic_terms(features), os.path.join(path, "info"))


def predict(regressor: PipelineModel, matrix: DataFrame) -> DataFrame:
    """(row_id, label, price, prediction, error, abs_error), stored once for the evaluation tables."""
    predictions = regressor.transform(matrix).select(KEY, "label", "price", "prediction")
    return materialize(evaluate.with_errors(predictions), "predictions")


def evaluation_tables(
    regressor: PipelineModel, matrix: DataFrame, dictionary: DataFrame, terms: DataFrame, n: int = 20
) -> dict[str, DataFrame]:
    """Every table of the evaluation report."""
    errors = predict(regressor, matrix)
    top = top_features(regressor, dictionary, n)
    return {
        "error_summary": evaluate.error_summary(errors),
        "error_histogram": histogram(errors, "error", 10),
        "calibration": evaluate.calibration_bins(errors),
        "axis_bounds": evaluate.axis_bounds(errors),
        "bias_by_score": evaluate.bias_by_score(errors),
        "error_bands": evaluate.error_bands(errors),
        "error_direction": evaluate.error_direction(errors),
        "price_by_direction": evaluate.price_by_direction(errors),
        "top_features": top,
        "topic_words": words_of_top_topics(top, terms, n),
    }


def run(raw: DataFrame, path: str, test_size: float = 0.2, **training) -> dict[str, DataFrame]:
    """All steps, with every hand-over stored under ``path``."""
    spark = raw.sparkSession
    split_path, model_path = os.path.join(path, "split"), os.path.join(path, "models")
    prepare(raw, split_path, test_size)
    trained = train(read_split(spark, split_path, "train"), **training)
    trained.save(model_path)
    features, regressor = load_models(model_path)
    for split in ("train", "test"):
        featurize(features, read_split(spark, split_path, split), trained.settings, os.path.join(path, split))
    matrix = read_features(spark, os.path.join(path, "test", "matrix"))
    return evaluation_tables(regressor, matrix, feature_dictionary(features), topic_terms(features))

