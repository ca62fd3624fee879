"""Column profiles: value counts, missing and distinct counts, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuvee.functions import text
from cuvee.functions.numeric import histogram_bin


FOLDED = ["country", "designation"]
AS_IS = ["province", "region_1", "region_2", "taster_name", "taster_twitter_handle", "variety", "winery"]


def profile_view(df: DataFrame, label: str | None = None) -> DataFrame:
    """The columns as they are profiled: two of them lower-cased and folded, the title stripped, the year extracted.

    ``label`` stands for missing values, except in title, year and price, whose missing values stay null.
    """

    def named(c: str):
        return F.col(c) if label is None else text.fill_missing(F.col(c), label)

    return df.select(
        *[text.fold(F.lower(named(c))).alias(c) for c in FOLDED],
        *[named(c).alias(c) for c in AS_IS],
        F.lower(text.strip_title(F.col("title"))).alias("title"),
        text.title_year(F.col("title")).alias("year"),
        "price",
    )


def value_counts(df: DataFrame, column: str, keep_missing: bool = False) -> DataFrame:
    """Rows per value, most frequent first; ties by value."""
    rows = df if keep_missing else df.where(F.col(column).isNotNull())
    return (
        rows.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_first("value"))
    )


def value_counts_all(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per (column, value) for all columns in a single shuffle of partial counts; null is a value."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: Registers of a sketch, as a power of two: a standard error of 1.04 / sqrt(2^12), that is 1.6 %.
SKETCH_SIZE = 12


def distinct_sketches(df: DataFrame, columns: list[str], part: Column | None = None) -> DataFrame:
    """(part, column, n_rows, n_missing, sketch): what is to be stored of each part of the data, a few kilobytes a column, from one pass over all
    columns. New files get sketches of their own, and ``united`` makes them one with the old, so nothing is read twice."""
    cells = (
        df.select((F.lit("") if part is None else part.cast("string")).alias("part"), *[F.col(c).cast("string").alias(f"c_{c}") for c in columns])
        .unpivot(["part"], [f"c_{c}" for c in columns], "column", "value")
        .withColumn("column", F.substring("column", 3, 1 << 20))
    )
    # The sketch leaves out null; a column of nulls has a sketch of nothing.
    return cells.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.hll_sketch_agg("value", SKETCH_SIZE).alias("sketch"),
    )


def united(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of several parts as one for each column (and each value of ``by``)."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_missing").alias("n_missing"), F.hll_union_agg("sketch").alias("sketch")
    )


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``sketches`` with ``n_distinct``, missing counted as one value, in place of the sketch. Few values are counted exactly."""
    n = F.hll_sketch_estimate("sketch") + (F.col("n_missing") > 0).cast("long")
    return sketches.withColumn("n_distinct", n).drop("sketch")


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, missing rows and distinct values (missing counted as one) of each column."""
    return (
        value_counts_all(df, columns)
        .groupBy("column")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
            F.count(F.lit(1)).alias("n_distinct"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins included.

    Two passes over one column: the bounds, then one counter per bin. NaN is a missing value, as null is.
    """
    x = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    counted = (
        df.where(x.isNotNull())
        .groupBy(histogram_bin(x, lo, hi, bins).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (hi - lo) / bins
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("bin") * width + lo).alias("from_value"),
            (F.when(F.col("bin") == bins - 1, F.lit(hi)).otherwise((F.col("bin") + 1) * width + lo)).alias("to_value"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )
