"""The feature vector: which blocks it has, in which order, and what each position means."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuvee.operators.encode import ExactMedianImputer, RareCategoryPooler, TargetMeanEncoder
from cuvee.operators.text import TermCounter
from cuvee.operators.topics import TextTopics, TextTopicsModel
from cuvee.runtime import discard, materialize
from cuvee.schema import ROLES, Roles


@dataclass(frozen=True)
class FeatureSettings:
    """Tunable parameters of the feature blocks. The defaults are those of the original job."""

    mean_min_count: int = 30
    pool_min_count: int = 30
    pool_min_count_winery: int = 10
    topics: dict[str, int] = field(default_factory=lambda: {"designation": 50, "description": 50, "title": 20})
    sublinear: dict[str, bool] = field(
        default_factory=lambda: {"designation": False, "description": True, "title": True}
    )
    max_iter: int = 500
    tol: float = 1e-4
    seed: int = 0
    pool_per_table: bool = False
    roles: Roles = ROLES

    def topic_choice(self, scope: object, column: str) -> tuple:
        """What the topics of a text column depend on within a search."""
        return scope, "topics", column, self.topics[column], self.sublinear[column]

    def with_values(self, values: dict[str, Any]) -> "FeatureSettings":
        """Settings with search values such as ``mean_min_count`` or ``topics.title`` put in."""
        changed: dict[str, Any] = {"topics": dict(self.topics), "sublinear": dict(self.sublinear)}
        for name, value in values.items():
            group, _, member = name.partition(".")
            if member:
                changed[group][member] = value
            else:
                changed[group] = value
        return replace(self, **changed)


class StageMemo:
    """Fitted stages by what they depend on, so that search candidates share them."""

    def __init__(self):
        self._fitted: dict[tuple, Any] = {}

    def fit(self, depends_on: tuple, make=None):
        if depends_on not in self._fitted:
            self._fitted[depends_on] = make()
        return self._fitted[depends_on]

    def tables(self) -> list[DataFrame]:
        """The stored tables among what was fitted."""
        return [x for x in self._fitted.values() if isinstance(x, DataFrame)]


def count_terms(df: DataFrame, settings: FeatureSettings) -> DataFrame:
    """Add the term counts, which no training depends on."""
    return TermCounter(inputCols=settings.roles.text).transform(df)


def fit_features(
    train: DataFrame, settings: FeatureSettings, memo: StageMemo | None = None, scope: object = None
) -> PipelineModel:
    """Fit every block on ``train``, a stored table of prepared reviews with term counts.

    Blocks are fitted side by side on the same table, not one on the output of the other. ``scope`` names the rows
    in ``train`` for the memo.
    """
    memo = memo or StageMemo()
    roles = settings.roles
    key, label, cats = roles.key, roles.label, roles.categorical

    min_counts = [settings.pool_min_count_winery if c == roles.sparse else settings.pool_min_count for c in cats]
    pooled = [f"{c}_pooled" for c in cats]

    def fit_median():
        return ExactMedianImputer(inputCols=roles.numeric, outputCols=[f"{c}_imputed" for c in roles.numeric]).fit(train)

    def fit_means():
        return TargetMeanEncoder(inputCols=cats, labelCol=label, minCount=settings.mean_min_count, keyCol=key).fit(train)

    def fit_levels():
        pooler = RareCategoryPooler(
            inputCols=cats, outputCols=pooled, minCounts=min_counts, keyCol=key, perTable=settings.pool_per_table
        ).fit(train)
        indexer = StringIndexer(
            inputCols=pooled, outputCols=[f"{c}_index" for c in cats], stringOrderType="alphabetAsc", handleInvalid="keep"
        )
        in_levels = pooler.transform(train.select(key, *cats))
        indexed = indexer.fit(in_levels)
        # The last index stands for unknown values; dropping it leaves one position per level and none for unknown.
        one_hot = OneHotEncoder(inputCols=indexer.getOutputCols(), outputCols=[f"{c}_levels" for c in cats])
        return pooler, indexed, one_hot.fit(indexed.transform(in_levels))

    def fit_topics(c: str) -> TextTopicsModel:
        return TextTopics(
            inputCols=[c], outputCols=[f"{c}_topics"], topics=[settings.topics[c]],
            sublinearCols=[c] if settings.sublinear[c] else [], keyCol=key, maxIter=settings.max_iter,
            tol=settings.tol, seed=settings.seed,
        ).fit(train)

    blocks = {
        (scope, "median"): fit_median,
        (scope, "mean", settings.mean_min_count): fit_means,
        (scope, "levels", *min_counts, settings.pool_per_table): fit_levels,
        **{settings.topic_choice(scope, c): partial(fit_topics, c) for c in roles.text},
    }
    # The blocks do not depend on each other, so their jobs may run at the same time.
    with ThreadPoolExecutor(len(blocks)) as pool:
        imputer, means, levels, *parts = pool.map(memo.fit, blocks.keys(), blocks.values())
    assembler = VectorAssembler(
        inputCols=[
            *imputer.outputs, *means.outputs, *[f"{c}_levels" for c in cats], *[f"{c}_topics" for c in roles.text]
        ],
        outputCol="features", handleInvalid="error",
    )
    return PipelineModel([imputer, means, *levels, TextTopicsModel.combine(parts), assembler])


def apply_features(model: PipelineModel, df: DataFrame, settings: FeatureSettings, memo: StageMemo | None = None) -> DataFrame:
    """(row_id, label, price, features) of any prepared table; price is the imputed one.

    The topic weights are stored first: in one plan with the encoders, whose joins would be run once more for the terms, the driver would have
    to plan and to hold much more. ``memo`` gets the stored table, for a caller that deletes it when the features have been read.
    """
    counted = df if "terms" in df.columns else count_terms(df, settings)
    *encoders, topics, assembler = model.stages
    arrays = (memo or StageMemo()).fit(("arrays",), lambda: materialize(topics.arrays(counted), "topic-arrays"))
    encoded = PipelineModel(encoders).transform(counted.drop("terms"))
    return _feature_rows(assembler.transform(topics.attach_arrays(encoded, arrays)), settings)


def store_features(model: PipelineModel, df: DataFrame, settings: FeatureSettings) -> DataFrame:
    """The same, stored."""
    memo = StageMemo()
    found = materialize(apply_features(model, df, settings, memo), "features")
    discard(*memo.tables())
    return found


def apply_with_memo(
    model: PipelineModel, df: DataFrame, settings: FeatureSettings, memo: StageMemo, scope: object, *keep: str
) -> DataFrame:
    """The same for a search: the topic weights of a column are computed once per choice, then joined."""
    *encoders, topics, assembler = model.stages
    arrays = [
        memo.fit(
            ("arrays", *settings.topic_choice(scope, c)),
            lambda c=c: materialize(memo.fit(settings.topic_choice(scope, c)).arrays(df), "topic-arrays"),
        )
        for c in settings.roles.text
    ]
    encoded = PipelineModel(encoders).transform(df.drop("terms"))
    return _feature_rows(assembler.transform(topics.attach_arrays(encoded, *arrays)), settings, *keep)


def _feature_rows(df: DataFrame, settings: FeatureSettings, *keep: str) -> DataFrame:
    label = F.col(settings.roles.label).cast("double").alias("label")
    return df.select(settings.roles.key, label, F.col(f"{settings.roles.price}_imputed").alias("price"), "features", *keep)


DICTIONARY_SCHEMA = T.StructType(
    [
        T.StructField("feature_idx", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("source_col", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
)


def feature_dictionary(model: PipelineModel) -> DataFrame:
    """One line per position of the feature vector; its length is the width of the vector."""
    imputer, means, _, indexer, _, topics, _ = model.stages
    lines: list[tuple] = [(c, c, "numeric", None, i) for i, c in enumerate(imputer.inputs)]
    lines += [(out, c, "mean", None, i) for i, (c, out) in enumerate(zip(means.inputs, means.outputs))]
    for c, labels in zip(means.inputs, indexer.labelsArray):
        lines += [(f"{c}_{level}", c, "level", level, i) for i, level in enumerate(labels)]
    for c, k in zip(topics.inputs, topics.get("topics")):
        lines += [(f"{c}_topic_{i}", c, "topic", None, i) for i in range(k)]
    spark = means.tables["means"].sparkSession
    return spark.createDataFrame([(i, *line) for i, line in enumerate(lines)], DICTIONARY_SCHEMA)


def topic_terms(model: PipelineModel) -> DataFrame:
    return model.stages[5].topic_terms()


