from conftest import rows

from pyspark.sql import functions as F

from cuvee.operators import profile


def test_value_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",), ("c",)], "x string")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert (None, 1) in rows(profile.value_counts(df, "x", keep_missing=True))


def test_profile_counts_missing_as_a_value(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    assert rows(profile.profile_columns(df, ["x", "y"])) == [("x", 3, 1, 3), ("y", 3, 3, 1)]


def test_all_columns_take_one_shuffle(spark):
    df = spark.createDataFrame([("b", 1)], "x string, y int")
    plan = profile.value_counts_all(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_united_sketches_equal_those_of_the_whole(spark):
    df = spark.range(30_000).select(
        (F.col("id") % 17).alias("few"), F.when(F.col("id") % 3 > 0, F.col("id") % 9000).alias("many"), F.lit(None).cast("string").alias("none"),
        (F.col("id") % 5).alias("part"), F.col("id").alias("column"),
    )
    columns = ["few", "many", "none", "column"]
    parts = profile.distinct_sketches(df, columns, F.col("part"))
    assert parts.count() == 20
    whole = profile.distinct_estimates(profile.distinct_sketches(df, columns)).collect()
    joined = {r["column"]: r for r in profile.distinct_estimates(profile.united(parts)).collect()}
    for r in whole:
        exact = {"few": 17, "many": 6001, "none": 1, "column": 30_000}[r["column"]]
        other = joined[r["column"]]
        assert (other["n_rows"], other["n_missing"]) == (r["n_rows"], r["n_missing"])
        assert abs(r["n_distinct"] - exact) <= 0.05 * exact and abs(other["n_distinct"] - exact) <= 0.05 * exact
    assert joined["few"]["n_distinct"] == 17 and joined["none"]["n_distinct"] == 1
    # In any order, and with parts united before.
    some = profile.united(parts.where("part < 2")).select(F.lit("a").alias("part"), "column", "n_rows", "n_missing", "sketch")
    later = profile.united(some.unionByName(parts.where("part >= 2")))
    assert {r["column"]: r["n_distinct"] for r in profile.distinct_estimates(later).collect()} == {c: r["n_distinct"] for c, r in joined.items()}


def test_one_pass_for_the_sketches_of_all_columns(spark):
    df = spark.range(10).select("id", F.col("id").alias("x"), F.col("id").alias("y"))
    plan = profile.distinct_sketches(df, ["x", "y"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def counts(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r["n"] for r in profile.histogram(df, "x", bins).orderBy("bin").collect()]


def test_histogram_edges(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    cases = [
        ([0.0, 1.0, 2.0, 4.0], 4),
        ([5.0, 5.0], 4),
        (list(np.round(rng.random(500), 2)), 7),
        (list(np.arange(0, 1.01, 0.1)), 10),
        (list(rng.normal(size=300)), 25),
    ]
    for values, bins in cases:
        assert counts(spark, [float(v) for v in values] + [None], bins) == np.histogram(values, bins)[0].tolist()


def test_histogram_leaves_out_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (1.2,)], "x double")
    found = profile.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r.from_value, r.to_value, r.n) for r in found] == [(1.0, 1.5, 2), (1.5, 2.0, 1)]
    nothing = profile.histogram(spark.createDataFrame([(float("nan"),)], "x double"), "x", 2)
    assert [r.n for r in nothing.collect()] == [0, 0]
