"""What jobs leave on disk and in the driver: shuffles end with the query that made them, plans stay small."""

import glob
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cuvee import runtime
from cuvee.operators import topics
from cuvee.operators.assemble import FeatureSettings, apply_features, count_terms, fit_features
from cuvee.operators.text import TermCounter
from cuvee.operators.topics import TextTopics
from cuvee.plans import rating
from cuvee.plans.fixture import reviews

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled(spark):
    """Bytes of the shuffles that are on disk."""
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(f) for at in folder for f in glob.glob(f"{at}/**/shuffle_*.data", recursive=True))


@pytest.fixture(scope="module")
def counted(spark):
    lines = [(i, " ".join(f"w{(i * j) % 17} v{(i + j) % 9}" for j in range(8)), f"n{i % 5} m{i % 3}") for i in range(80)]
    df = spark.createDataFrame(lines, "row_id long, body string, note string")
    return runtime.materialize(TermCounter(inputCols=["body", "note"]).transform(df), "counted")


def test_a_hand_over_leaves_no_shuffle_and_the_setting_as_it_was(spark):
    rows = spark.range(50_000).groupBy((F.col("id") % 20_000).alias("k")).agg(F.sum("id").alias("s"))
    before, kept = shuffled(spark), spark.conf.get(SETTING)
    assert runtime.materialize(rows, "t").count() == 20_000
    assert shuffled(spark) <= before + 10_000  # the count's own
    assert spark.conf.get(SETTING) == kept
    with runtime.shuffles_dropped(spark), runtime.shuffles_dropped(spark):
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING) == kept


@pytest.mark.parametrize("cells", [1 << 20, 0])
def test_rounds_of_a_topic_fit_leave_no_shuffles_and_no_rows(spark, counted, monkeypatch, cells):
    monkeypatch.setattr(topics, "DENSE_CELLS", cells)
    stored, keep = [], topics.materialize
    monkeypatch.setattr(topics, "materialize", lambda df, label: stored.append((label, keep(df, label))) or stored[-1][1])
    fitting = TextTopics(inputCols=["body", "note"], outputCols=["b", "n"], topics=[3, 2], maxIter=6, tol=0.0, seed=1)
    fitted = []
    before = shuffled(spark)
    fitted.append(fitting.fit(counted))
    grown = shuffled(spark) - before
    assert grown < 60_000  # of the vocabulary, whatever the number of rounds
    left = [label for label, table in stored if os.path.isdir(table._stored_at.removeprefix("file:"))]
    assert left == ["components"]
    assert fitted[0].weights(counted).count() == 160


def test_the_start_of_the_components_is_neither_stored_nor_shipped(counted, monkeypatch):
    labels, keep = [], topics.materialize
    monkeypatch.setattr(topics, "materialize", lambda df, label: labels.append(label) or keep(df, label))
    monkeypatch.setattr(topics, "DENSE_CELLS", 0)
    TextTopics(inputCols=["body"], outputCols=["b"], topics=[3], maxIter=3, tol=0.0, seed=1).fit(counted)
    assert labels.index("term-sums") < labels.index("components")


def test_features_are_put_together_from_stored_topic_weights(spark, sf_dir, folder):
    from cuvee.sources.reviews import read_split

    raw = reviews(spark, sf_dir).limit(200).withColumn("description", F.substring_index("description", ".", 1))
    rating.prepare(raw, folder)
    settings = FeatureSettings(max_iter=2, topics={"designation": 2, "description": 2, "title": 2})
    counted = runtime.materialize(count_terms(read_split(spark, folder, "train"), settings), "train")
    model = fit_features(counted, settings)
    found = apply_features(model, counted, settings)
    # The terms are not taken apart again in the plan of the encoders.
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    whole = model.transform(counted).select("row_id", "features").collect()
    assert sorted((r["row_id"], r["features"]) for r in whole) == sorted((r["row_id"], r["features"]) for r in found.collect())
    assert isinstance(model, PipelineModel) and len(whole) == 160
