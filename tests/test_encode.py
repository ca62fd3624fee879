import pytest
from conftest import rows, spread
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cuvee.operators import encode, scale

DATA = [
    (0, "a", "x", 80), (1, "a", "y", 90), (2, "a", None, 100), (3, "b", "x", 85), (4, "b", "x", 95), (5, None, "z", 88),
]
SCHEMA = "row_id long, c string, d string, points int"


@pytest.fixture()
def train(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_target_means(spark, train):
    model = encode.TargetMeanEncoder(inputCols=["c", "d"], minCount=2).fit(train)
    test = spark.createDataFrame([(9, "a", "x", 0), (10, "b", "z", 0), (11, "new", None, 0)], SCHEMA)
    overall = sum(r[3] for r in DATA) / len(DATA)
    got = rows(model.transform(test), "row_id", "c_avg_points", "d_avg_points")
    assert got == [(10, 90.0, overall), (11, overall, overall), (9, 90.0, (80 + 85 + 95) / 3)]


def test_target_mean_fallback_value(train):
    model = encode.TargetMeanEncoder(inputCols=["c"], minCount=3, unknownValue=-1.0).fit(train)
    assert [r[1] for r in rows(model.transform(train), "row_id", "c_avg_points")] == [90.0, 90.0, 90.0, -1.0, -1.0, -1.0]


def test_means_take_one_shuffle(train):
    plan = encode.target_mean_table(train, ["c", "d"], "points", 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_pooling_of_the_table_itself(train):
    got = rows(encode.pool_rare(train, {"c": 2, "d": 3}), "row_id", "c", "d")
    assert got == [
        (0, "a", "x"), (1, "a", "_other_"), (2, "a", "_other_"), (3, "b", "x"), (4, "b", "x"), (5, "_other_", "_other_"),
    ]


def test_fitted_pooling_keeps_training_values(spark, train):
    test = spark.createDataFrame([(9, "b", "x", 0)], SCHEMA)
    fitted = encode.RareCategoryPooler(inputCols=["c", "d"], minCounts=[2, 3]).fit(train)
    assert rows(fitted.transform(test), "c", "d") == [("b", "x")]
    own = encode.RareCategoryPooler(inputCols=["c", "d"], minCounts=[2, 3], perTable=True).fit(train)
    assert rows(own.transform(test), "c", "d") == [("_other_", "_other_")]


@pytest.mark.parametrize("partitions", [1, 4, 17])
@pytest.mark.parametrize("limit", [scale.BROADCAST_BYTES, 0])
def test_results_do_not_depend_on_partitions_or_join(spark, monkeypatch, partitions, limit):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 90))
    df = spark.range(900).select(
        F.col("id").alias("row_id"), key.alias("c"), (F.col("id") % 11).cast("string").alias("d"),
        (F.col("id") % 21 + 80).cast("int").alias("points"),
    )

    def results(frame):
        means = encode.TargetMeanEncoder(inputCols=["c", "d"], minCount=8).fit(frame).transform(frame)
        pooled = encode.pool_rare(frame, {"c": 7, "d": 82})
        dictionary = encode.category_dictionary(frame, ["c", "d"])
        ones = encode.one_hot_long(frame, dictionary, ["c", "d"])
        return rows(means, "row_id", "c_avg_points", "d_avg_points"), rows(pooled), rows(ones)

    expected = results(df)
    monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
    assert results(spread(df, partitions)) == expected


def test_save_and_load(spark, train, folder):
    prices = train.withColumn("price", F.when(F.col("row_id") > 1, F.col("row_id").cast("double")))
    model = PipelineModel(
        [
            encode.ExactMedianImputer(inputCols=["price"]).fit(prices),
            encode.TargetMeanEncoder(inputCols=["c"], minCount=2).fit(prices),
            encode.RareCategoryPooler(inputCols=["d"], minCounts=[2]).fit(prices),
        ]
    )
    model.save(folder + "/m")
    loaded = PipelineModel.load(folder + "/m")
    assert rows(loaded.transform(prices)) == rows(model.transform(prices))
    assert rows(model.transform(prices), "row_id", "price")[0] == (0, 3.5)


def test_one_hot_orders_levels_and_ignores_unknown(spark, train):
    dictionary = encode.category_dictionary(train, ["d", "c"])
    assert rows(dictionary, "idx", "column", "value") == [
        (0, "d", "x"), (1, "d", "y"), (2, "d", "z"), (3, "c", "a"), (4, "c", "b"),
    ]
    test = spark.createDataFrame([(9, "b", "new", 0), (10, None, "z", 0)], SCHEMA)
    assert rows(encode.one_hot_long(test, dictionary, ["d", "c"])) == [(10, "d", 2), (9, "c", 4)]


def test_out_of_fold_means_by_brute_force(spark):
    import random

    from cuvee.operators.encode import TargetMeanEncoder

    rng = random.Random(2)
    data = [(i, rng.choice(["a", "b", "c", None]), float(rng.randrange(10)), i % 3) for i in range(60)] + [(60, "rare", 5.0, 0)]
    df = spark.createDataFrame(data, "row_id long, country string, points double, fold int").repartition(5)
    encoder = TargetMeanEncoder(inputCols=["country"], outputCols=["m"], labelCol="points", minCount=3, foldCol="fold")
    for r in encoder.encode_training(df).collect():
        rest = [d for d in data if d[3] != r.fold]
        same = [d[2] for d in rest if d[1] == r.country and r.country is not None]
        want = sum(same) / len(same) if len(same) >= 3 else sum(d[2] for d in rest) / len(rest)
        assert r.m == pytest.approx(want)
