"""Numeric imputation, target means, rare categories and category dictionaries."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.operators.profile import value_counts_all
from cuvee.operators.scale import attach, attach_columns, exact_medians, ordered_index, small_columns
from cuvee.operators.stages import ParamEstimator, TableModel
from cuvee.runtime import materialize
from cuvee.schema import KEY, LABEL, POOLED


class ExactMedianImputer(ParamEstimator):
    """Null and NaN become the exact training median of the column (``pyspark.ml`` only offers an approximate one)."""

    def _fit(self, df: DataFrame) -> "ExactMedianImputerModel":
        medians = exact_medians(df, {c: F.col(c) for c in self.inputs})
        return ExactMedianImputerModel().of(self, state={"medians": medians})


class ExactMedianImputerModel(TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        outputs = self.outputs if self.isDefined(self.outputCols) else self.inputs
        filled = {
            out: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(self.state["medians"][c]))
            for c, out in zip(self.inputs, outputs)
        }
        return df.withColumns(filled)


def target_mean_table(df: DataFrame, columns: list[str], label: str = LABEL, min_count: int = 2) -> DataFrame:
    """Rows and mean label per (column, value) with at least ``min_count`` rows, in one shuffle of partial sums."""
    return (
        df.select(F.col(label).cast("double").alias("_label"), *columns)
        .unpivot("_label", columns, "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("_label").alias("mean"))
        .where(F.col("n") >= min_count)
    )


def out_of_fold_means(
    df: DataFrame, columns: dict[str, str], label: str, fold: str, min_count: int = 2, unknown: float | None = None, key: str = KEY
) -> DataFrame:
    """``df`` with an output per column: the mean label of the value over the rows of all other folds.

    Values with fewer than ``min_count`` rows there, and nulls, get ``unknown``, by default the mean over all rows of the other
    folds. One shuffle of partial sums per (column, value, fold); the sums of the other folds follow by subtraction.
    """
    names = list(columns)
    long = df.select(F.col(label).cast("double").alias("_label"), F.col(fold).cast("long").alias("_fold"), *names)
    own = (
        long.unpivot(["_label", "_fold"], names, "column", "value").where(F.col("value").isNotNull())
        .groupBy("column", "value", "_fold").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("s"))
    )
    own = materialize(own, "fold-sums")
    every = own.groupBy("column", "value").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    rest = own.join(every, ["column", "value"]).where(F.col("all_n") - F.col("n") >= F.greatest(F.lit(min_count), F.lit(1)))
    means = materialize(
        rest.select(
            "column", F.concat_ws(":", "_fold", "value").alias("value"),
            ((F.col("all_s") - F.col("s")) / (F.col("all_n") - F.col("n"))).alias("mean"),
        ),
        "fold-means",
    )
    # A line per fold.
    totals = {r["_fold"]: (r["n"], r["s"]) for r in long.groupBy("_fold").agg(F.count("_label").alias("n"), F.sum("_label").alias("s")).collect()}
    n, s = sum(t[0] for t in totals.values()), sum(t[1] or 0.0 for t in totals.values())
    fallback = F.lit(unknown)
    if unknown is None:
        for at, (own_n, own_s) in totals.items():
            mean = (s - (own_s or 0.0)) / (n - own_n) if n > own_n else None
            fallback = F.when(F.col(fold).eqNullSafe(F.lit(at)), F.lit(mean)).otherwise(fallback)
    marked = {c: f"_in_fold_{c}" for c in names}
    rows = df.withColumns({m: F.when(F.col(c).isNotNull(), F.concat_ws(":", F.col(fold).cast("long"), F.col(c))) for c, m in marked.items()})
    lookup = reduce(DataFrame.unionAll, [means.where(F.col("column") == c).withColumn("column", F.lit(m)) for c, m in marked.items()])
    joined = attach_columns(rows, lookup, list(marked.values()), [key], small_columns(lookup))
    return joined.select(*df.columns, *[F.coalesce(f"_x_{m}", fallback).alias(columns[c]) for c, m in marked.items()])


class TargetMeanEncoder(ParamEstimator):
    """Each category becomes the mean training label of its value.

    Values with fewer than ``minCount`` training rows, unseen values and nulls get ``unknownValue``, by default the
    mean over all training rows. The means are taken on the training rows themselves. With ``foldCol``, ``encode_training``
    gives the training rows means of the other folds instead; ``transform`` stays as it is.
    """

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    minCount = Param(Params._dummy(), "minCount", "fewest rows for a mean of its own", TypeConverters.toInt)
    unknownValue = Param(Params._dummy(), "unknownValue", "fallback; unset: overall mean", TypeConverters.toFloat)
    keyCol = Param(Params._dummy(), "keyCol", "row id column", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold column for out-of-fold means; unset: none", TypeConverters.toString)
    defaults = {"labelCol": LABEL, "minCount": 2, "keyCol": KEY}

    def encode_training(self, df: DataFrame) -> DataFrame:
        """The training rows, each encoded by the rows of the other folds; with no ``foldCol`` by all of them."""
        if not self.isDefined(self.foldCol):
            return self.fit(df).transform(df)
        outputs = self.get("outputCols") if self.isDefined(self.outputCols) else [f"{c}_avg_{self.get('labelCol')}" for c in self.inputs]
        unknown = self.get("unknownValue") if self.isDefined(self.unknownValue) else None
        return out_of_fold_means(
            df, dict(zip(self.inputs, outputs)), self.get("labelCol"), self.get("foldCol"), self.get("minCount"), unknown, self.get("keyCol")
        )

    def _fit(self, df: DataFrame) -> "TargetMeanEncoderModel":
        label = self.get("labelCol")
        means = materialize(target_mean_table(df, self.inputs, label, self.get("minCount")), "target-means")
        fallback = self.get("unknownValue") if self.isDefined(self.unknownValue) else df.agg(F.avg(label)).first()[0]
        return TargetMeanEncoderModel().of(
            self, state={"fallback": fallback, "small": small_columns(means)}, means=means
        )


class TargetMeanEncoderModel(TableModel):
    labelCol, minCount = TargetMeanEncoder.labelCol, TargetMeanEncoder.minCount
    unknownValue, keyCol = TargetMeanEncoder.unknownValue, TargetMeanEncoder.keyCol
    table_names = ("means",)

    @property
    def outputs(self) -> list[str]:
        if self.isDefined(self.outputCols):
            return self.get("outputCols")
        return [f"{c}_avg_{self.get('labelCol')}" for c in self.inputs]

    def _transform(self, df: DataFrame) -> DataFrame:
        fallback = F.lit(self.state["fallback"])
        means = self.tables["means"].select("column", "value", "mean")
        joined = attach_columns(df, means, self.inputs, [self.get("keyCol")], self.state["small"])
        encoded = [F.coalesce(f"_x_{c}", fallback).alias(out) for c, out in zip(self.inputs, self.outputs)]
        return joined.select(*df.columns, *encoded)


def _pool(
    df: DataFrame, kept: DataFrame, columns: dict[str, str], pooled: str, key: str, small: dict[str, bool]
) -> DataFrame:
    """Replace values that are not in ``kept(column, value)``; ``columns`` maps input to output names."""
    marked = kept.select("column", "value", F.lit(True).alias("kept"))
    joined = attach_columns(df, marked, list(columns), [key], small)
    outputs = {out: F.when(F.col(f"_x_{c}"), F.col(c)).otherwise(pooled) for c, out in columns.items()}
    return joined.withColumns(outputs).drop(*[f"_x_{c}" for c in columns])


def _frequent(df: DataFrame, min_counts: dict[str, int]) -> DataFrame:
    counts = value_counts_all(df, list(min_counts)).where(F.col("value").isNotNull())
    limit = F.create_map(*[F.lit(x) for pair in min_counts.items() for x in pair])
    return counts.where(F.col("n") >= limit[F.col("column")])


def pool_rare(df: DataFrame, min_counts: dict[str, int], pooled: str = POOLED, key: str = KEY) -> DataFrame:
    """Pool the values that are rare in ``df`` itself; nulls are pooled too.

    Stateless: each table is pooled by its own counts. Counts come from one grouped job over all columns rather than
    from a window per column, whose largest value would have to pass through one task.
    """
    kept = materialize(_frequent(df, min_counts), "frequent")
    return _pool(df, kept, {c: c for c in min_counts}, pooled, key, small_columns(kept))


class RareCategoryPooler(ParamEstimator):
    """Values with fewer than ``minCounts`` training rows, unseen values and nulls become ``pooledValue``."""

    minCounts = Param(Params._dummy(), "minCounts", "fewest rows per input column", TypeConverters.toListInt)
    pooledValue = Param(Params._dummy(), "pooledValue", "value that replaces rare ones", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row id column", TypeConverters.toString)
    perTable = Param(
        Params._dummy(), "perTable", "pool each table by its own counts instead of the training counts",
        TypeConverters.toBoolean,
    )
    defaults = {"pooledValue": POOLED, "keyCol": KEY, "perTable": False}

    def _fit(self, df: DataFrame) -> "RareCategoryPoolerModel":
        kept = materialize(_frequent(df, dict(zip(self.inputs, self.get("minCounts")))), "frequent")
        return RareCategoryPoolerModel().of(self, state={"small": small_columns(kept)}, kept=kept)


class RareCategoryPoolerModel(TableModel):
    minCounts, pooledValue = RareCategoryPooler.minCounts, RareCategoryPooler.pooledValue
    keyCol, perTable = RareCategoryPooler.keyCol, RareCategoryPooler.perTable
    table_names = ("kept",)

    def _transform(self, df: DataFrame) -> DataFrame:
        outputs = self.outputs if self.isDefined(self.outputCols) else self.inputs
        kept, small = self.tables["kept"], self.state["small"]
        if self.get("perTable"):
            kept = materialize(_frequent(df, dict(zip(self.inputs, self.get("minCounts")))), "frequent")
            small = small_columns(kept)
        columns = dict(zip(self.inputs, outputs))
        return _pool(df, kept, columns, self.get("pooledValue"), self.get("keyCol"), small)


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, idx): one-hot position of every value, columns in the given order, values sorted."""
    rank = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    values = value_counts_all(df, columns).where(F.col("value").isNotNull())
    ordered = ordered_index(values.withColumn("_rank", rank[F.col("column")]), ["_rank", "value"], "idx")
    return ordered.select("column", "value", "idx")


def one_hot_long(df: DataFrame, dictionary: DataFrame, columns: list[str], key: str = KEY) -> DataFrame:
    """The ones of the one-hot matrix as (key, column, idx); unknown values and nulls have none."""
    long = df.select(key, *columns).unpivot(key, columns, "column", "value")
    return (
        attach(long, dictionary, ["column", "value"], [key])
        .where(F.col("idx").isNotNull())
        .select(key, "column", "idx")
    )
