import pytest
from conftest import rows, spread
from pyspark.sql import functions as F

from cuvee.operators import evaluate, split
from cuvee.runtime import materialize


def test_prefix_truncates(spark):
    df = spark.range(7).withColumnRenamed("id", "row_id")
    assert rows(split.split_prefix(df, 0.5).where("split = 'test'"), "row_id") == [(0,), (1,), (2,)]


@pytest.mark.parametrize("n,k", [(10, 3), (3, 5), (100, 7), (5, 5), (1, 2)])
def test_folds_have_the_published_sizes(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    want = [f for f in range(k) for _ in range(n // k + (f < n % k))]
    assert [r["fold"] for r in split.kfold(df, k).orderBy("row_id").collect()] == want


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_hash_split_and_sample_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(2000).select(F.col("id").alias("row_id"), (F.col("id") % 7).alias("v"))
    other = spread(df, partitions)
    assert rows(split.split_hash(df, 0.2, 3)) == rows(split.split_hash(other, 0.2, 3))
    assert rows(split.sample_rows(df, 100, 3)) == rows(split.sample_rows(other, 100, 3))
    assert split.sample_rows(other, 100, 3).count() == 100
    share = split.split_hash(df, 0.2, 3).where("split = 'test'").count() / 2000
    assert 0.15 < share < 0.25
    assert rows(split.split_hash(df, 0.2, 3)) != rows(split.split_hash(df, 0.2, 4))


@pytest.mark.parametrize("ids", [range(0, 100, 10), range(1000, 1010), [5, 5, 5, 7, 7, 9, 9, 9, 9, 1], range(10)])
def test_ids_with_gaps_give_the_same_sizes(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    folds = [r["fold"] for r in split.kfold(df, 5).orderBy("row_id", "fold").collect()]
    assert sorted(folds) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert rows(split.split_prefix(df, 0.3).where("split = 'test'"), "row_id") == [(i,) for i in sorted(ids)[:3]]


def test_ties_do_not_depend_on_the_partitions(spark):
    """Rows that share an id fall to a set, or a fold, by their other columns."""
    df = spark.range(4000).select((F.col("id") % 700).alias("row_id"), F.xxhash64("id").alias("v"), F.array(F.col("id")).alias("a"))
    found = []
    for n in (1, 4, 17):
        given = spread(df.drop("a"), n)
        found.append((rows(split.split_prefix(given, 0.2)), rows(split.kfold(given, 3))))
    assert found[0] == found[1] == found[2]
    assert split.split_prefix(df, 0.2).where("split = 'test'").count() == 800


@pytest.mark.parametrize(
    "ids,contiguous",
    [(range(100_000), True), ([0, 1, 1, 3], False), ([0, 1, None, 2], False), ([-1, 0, 1, 2], False), ([1, 2, 3], False), ([], True), ([0], True),
     ([0, 2**40], False), ([0, 1, 2, 2, 4, 5], False)],
)
def test_keys_in_one_pass(spark, ids, contiguous):
    ids = list(ids)
    df = spark.createDataFrame([(i,) for i in ids], "row_id long")
    assert split.keys_of(df) == split.Keys(len(ids), contiguous)
    assert split.keys_of(df.select(F.col("row_id").cast("string"))) == split.Keys(len(ids), False)


def test_one_job_before_a_split(spark):
    """Numbers of rows, the range of the keys and whether they repeat come from one aggregate."""
    df = materialize(spark.range(1000).withColumnRenamed("id", "row_id"), "one-job")
    spark.sparkContext.setJobGroup("split-jobs", "split")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        split.split_prefix(df, 0.2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("split-jobs")) == 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "row_id long, label double, prediction double, price double")
    assert split.kfold(df, 5).count() == split.split_prefix(df, 0.2).count() == 0
    errors = evaluate.with_errors(df)
    assert {r.pct for r in evaluate.error_bands(errors).collect()} == {None}
    assert {r.pct for r in evaluate.error_direction(errors).collect()} == {None}
