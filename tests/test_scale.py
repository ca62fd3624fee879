import statistics

import pytest
from conftest import rows, spread
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuvee import runtime
from cuvee.operators import scale


def test_median_of_even_count_is_the_middle(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,), (float("nan"),)], "x double")
    assert scale.exact_medians(df, {"x": F.col("x"), "none": F.lit(None)}) == {"x": 2.5, "none": None}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(st.floats(-1e12, 1e12), st.floats(0, 1e-9), st.integers(-3, 3).map(float)), min_size=1, max_size=60
    )
)
def test_median_equals_sorting(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    assert scale.exact_medians(df, {"x": F.col("x")})["x"] == statistics.median(values)


def test_median_narrows_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(scale, "MEDIAN_BUCKETS", 2)
    df = spark.range(1000).select((F.col("id") * F.col("id")).cast("double").alias("x"))
    assert scale.exact_medians(df, {"x": F.col("x")})["x"] == (499**2 + 500**2) / 2


@pytest.fixture()
def skewed(spark):
    """A third of the rows on one key, some null keys, many rare ones."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 700))
    data = spark.range(6000).select(F.col("id").alias("row_id"), key.alias("k"))
    lookup = data.where("k is not null and k <> 'k5'").groupBy("k").agg(F.count("*").alias("n"))
    return data, lookup


def test_attach_by_shuffle_equals_broadcast(skewed):
    data, lookup = skewed
    broadcast = scale.attach(data, lookup, ["k"], ["row_id"], small=True)
    shuffled = scale.attach(data, lookup, ["k"], ["row_id"], small=False)
    assert broadcast.columns == shuffled.columns
    assert rows(broadcast) == rows(shuffled)
    assert shuffled.count() == 6000


def test_attach_spreads_the_hot_key(spark, skewed):
    data, lookup = skewed
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = scale.attach(data, lookup, ["k"], ["row_id"], small=False)
        per_task = joined.groupBy(F.spark_partition_id()).count().select(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert per_task < 0.4 * 6000


def test_size_decides(skewed):
    _, lookup = skewed
    assert scale.fits_broadcast(lookup)
    assert not scale.fits_broadcast(lookup, 100)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_positions(spark, partitions):
    df = spread(spark.range(300).select((F.col("id") * 7).alias("v")), partitions)
    assert rows(scale.ordered_index(df, ["v"], "at"), "at", "v") == sorted([(i, i * 7) for i in range(300)], key=repr)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = runtime.shared_dir(spark)
    assert folder == named if named else folder
    assert runtime.new_path(spark, "x").startswith(folder)


@pytest.mark.parametrize(
    "values",
    [
        [1.0, float("inf"), float("inf")], [float("-inf"), 2.0, 3.0, float("inf")], [1e308, 1.0000000000000002e308, 1.7e308, -1e308],
        [1e308, 1.0000000000000002e308, 1.0000000000000004e308], [5e-324, 0.0, -5e-324, 1e300], [-1e301, 7.0, 1e301, 8.0, None],
    ],
)
def test_medians_over_the_whole_range_of_doubles(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    want = statistics.median(v for v in values if v is not None)
    assert scale.exact_medians(df, {"x": F.col("x")})["x"] == want
