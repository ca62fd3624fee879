import random

import pytest
from conftest import rows
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cuvee.operators import forest
from cuvee.operators.assemble import FeatureSettings, apply_features, count_terms, feature_dictionary, fit_features
from cuvee.plans import rating
from cuvee.plans.fixture import reviews
from cuvee.runtime import materialize
from cuvee.schema import KEY
from cuvee.sources.features import read_feature_dictionary, read_features

SMALL = FeatureSettings(
    mean_min_count=20, pool_min_count=60, pool_min_count_winery=8, max_iter=3,
    topics={"designation": 2, "description": 3, "title": 2},
)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(4)
    lines = []
    for i in range(300):
        x = [rng.random() for _ in range(12)]
        lines.append((i, 10 * x[3] + 5 * x[7] + 0.1 * rng.random(), Vectors.dense(x)))
    return spark.createDataFrame(lines, ["row_id", "label", "features"]).repartition(4).cache()


def test_elimination_keeps_the_strong_features(spark, matrix):
    small = forest.forest(trees=15, leaf=2, per_split="all", depth=5, seed=1)
    sizes = []
    got = forest.eliminate(matrix, small, keep=2, step=4, on_round=lambda m, i: sizes.append(len(i)))
    assert sizes == [12, 8, 4, 2]
    assert got.kept == [3, 7]
    again = forest.eliminate(matrix, small, keep=2, step=4)
    assert again.dropped_in_round == got.dropped_in_round
    assert rows(got.support(spark).where("kept"), "feature_idx") == [(3,), (7,)]
    assert got.support(spark).count() == 12
    predictions = got.model.transform(matrix)
    low, high = matrix.agg(F.min("label"), F.max("label")).first()
    assert predictions.where(~F.col("prediction").between(low, high)).count() == 0


def test_validated_elimination_picks_the_smallest_of_the_best(spark, matrix):
    scores = spark.createDataFrame(
        [(0, 12, 1.0), (1, 12, 3.0), (0, 8, 2.0), (1, 8, 2.0), (0, 4, 5.0), (1, 4, 5.0)], "fold int, n_features int, mse double"
    )
    assert forest.best_size(scores) == 8
    folded = matrix.withColumn("fold", (F.col("row_id") % 2).cast("int")).cache()
    small = forest.forest(trees=5, leaf=2, per_split="all", depth=4, seed=1)
    elimination, scores = forest.eliminate_by_validation(folded, small, folds=2, step=5)
    assert rows(scores.select("fold", "n_features")) == [(f, n) for f in (0, 1) for n in (1, 12, 2, 7)]
    assert len(elimination.kept) == forest.best_size(scores)


def test_candidates_are_distinct_and_seeded():
    drawn = forest.sample_candidates(forest.SEARCH_SPACE, 100, 9)
    assert len({repr(c) for c in drawn}) == 100
    assert drawn == forest.sample_candidates(forest.SEARCH_SPACE, 100, 9)
    total = 1
    for values in forest.SEARCH_SPACE.values():
        total *= len(values)
    assert total == 116640
    assert len(forest.sample_candidates({"leaf": [1, 2], "trees": [3]}, 100, 9)) == 2


def test_top_features_are_named_through_the_kept_positions(spark, matrix):
    small = forest.forest(trees=10, leaf=2, per_split="all", depth=5, seed=1)
    model = forest.eliminate(matrix, small, keep=2, step=10).model
    dictionary = spark.createDataFrame(
        [(i, f"f{i}", f"f{i}", "numeric", None, i) for i in range(12)],
        "feature_idx int, name string, source_col string, kind string, level string, ordinal int",
    )
    top = forest.top_features(model, dictionary).collect()
    assert [r["name"] for r in top] == ["f3", "f7"]
    assert [r["name_as_reported"] for r in top] == ["f0", "f1"]


@pytest.fixture(scope="module")
def prepared(spark, sf_dir):
    from cuvee.runtime import new_path
    from cuvee.sources.reviews import read_split

    path = new_path(spark, "prepared")
    raw = reviews(spark, sf_dir).withColumn("description", F.substring_index("description", ".", 2))
    rating.prepare(raw, path)
    return read_split(spark, path, "train"), read_split(spark, path, "test")


def test_prepared_table(prepared):
    train, test = prepared
    assert train.count() == 1200 and test.count() == 300
    # The key, the 13 raw columns, the year and the id as it was.
    assert len(train.columns) == 16
    assert train.where("description is null or title is null or winery is null").count() == 0


def test_features_match_their_dictionary(prepared, folder):
    train, test = prepared
    counted = materialize(count_terms(train, SMALL), "train")
    model = fit_features(counted, SMALL)
    dictionary = feature_dictionary(model)
    names = [r["name"] for r in dictionary.orderBy("feature_idx").collect()]
    got = {r[KEY]: r for r in apply_features(model, test, SMALL).collect()}
    assert len(got) == 300
    assert all(r["features"].size == len(names) for r in got.values())
    assert [r["feature_idx"] for r in dictionary.orderBy("feature_idx").collect()] == list(range(len(names)))
    kinds = [r["kind"] for r in dictionary.orderBy("feature_idx").collect()]
    assert kinds == sorted(kinds, key=["numeric", "mean", "level", "topic"].index)
    assert kinds.count("numeric") == 2 and kinds.count("mean") == 7 and kinds.count("topic") == 7
    # Each row has at most one level per category, and the position agrees with the name.
    for r in test.select(KEY, "province", "price").collect():
        vector = got[r[KEY]]["features"]
        level = f"province_{r['province']}"
        for i, name in enumerate(names):
            if name.startswith("province_") and kinds[i] == "level":
                assert vector[i] == float(name == level or (name == "province__other_" and level not in names))
        if r["price"] is not None:
            assert vector[1] == r["price"] == got[r[KEY]]["price"]

    rating.featurize(model, test, SMALL, folder + "/f")
    test.sparkSession.catalog.clearCache()
    assert read_features(test.sparkSession, folder + "/f/matrix").count() == 300
    stored, terms = read_feature_dictionary(test.sparkSession, folder + "/f/info")
    assert rows(stored) == rows(dictionary)
    assert terms.where("weight < 0").count() == 0


def test_train_both_modes_save_and_load(prepared, folder):
    train, test = prepared
    fixed = rating.train(train, SMALL, keep=10, step=0.5, trees=5, depth=4)
    assert len(fixed.elimination.kept) == 10
    fixed.save(folder + "/m")
    features, regressor = rating.load_models(folder + "/m")
    one = rating.predict(fixed.elimination.model, apply_features(fixed.features, test, SMALL))
    two = rating.predict(regressor, apply_features(features, test, SMALL))
    columns = [KEY, F.round("prediction", 6)]
    assert rows(one.select(*columns)) == rows(two.select(*columns))

    space = {"mean_min_count": [20, 40], "topics.title": [2], "leaf": [5, 10], "trees": [4]}
    searched = rating.train(
        train, SMALL, select_model=True, n_iter=3, folds=2, step=0.6, depth=4, space=space
    )
    results = searched.results.collect()
    assert len(results) == 6 and {r["rank"] for r in results} <= {1, 2, 3}
    means = {r["candidate"]: r["mean_mse"] for r in results}
    best = min(means, key=means.get)
    assert {r["candidate"] for r in results if r["rank"] == 1} >= {best}
    searched.save(folder + "/s")
    back = train.sparkSession.read.csv(folder + "/s/search_results", header=True)
    assert back.count() == 6


def test_forests_do_not_depend_on_the_partitions(spark, matrix):
    from conftest import spread

    small = forest.forest(trees=6, leaf=2, depth=5, seed=1)
    found = []
    for n in (1, 4, 17):
        rows_ = matrix.orderBy(F.xxhash64("row_id", F.lit(n))).repartition(n)
        got = forest.eliminate(rows_, small, keep=4, step=5)
        found.append((got.kept, rows(got.model.transform(matrix).select("row_id", "prediction"))))
    assert found[0] == found[1] == found[2]


def test_a_search_leaves_no_tables_of_its_own(spark, sf_dir, folder):
    import os

    from cuvee.operators.split import split_prefix
    from cuvee.plans.rating import clean
    from cuvee.runtime import shared_dir

    train = materialize(split_prefix(clean(reviews(spark, sf_dir).limit(150)), 0.2).where("split = 'train'").drop("split"), "search-input")
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    space = {"leaf": [5, 10], "topics.title": [2], "trees": [3]}
    results, _ = forest.search(train, SMALL, space, n_iter=2, folds=2, depth=3, partitions=2)
    assert results.count() == 4
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before}
    assert not left & {"search-features", "topic-arrays", "search-train"}


def test_prepare_keeps_every_row_of_ids_with_gaps_and_repeats(spark, sf_dir, folder):
    from cuvee.sources.reviews import read_split

    raw = reviews(spark, sf_dir).limit(40).withColumn(KEY, F.when(F.col(KEY) % 7 == 0, 500).otherwise(F.col(KEY) * 10))
    rating.prepare(raw, folder, 0.25)
    both = [read_split(spark, folder, s).collect() for s in ("test", "train")]
    assert [len(b) for b in both] == [10, 30]
    assert sorted(r[KEY] for b in both for r in b) == list(range(40))
    assert sorted(r.original_id for b in both for r in b) == sorted(r[0] for r in raw.select(KEY).collect())
    words = {(r.points, r.title) for r in raw.collect()}
    assert len(words) > 30 and all(r.description for b in both for r in b)
