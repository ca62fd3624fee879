"""Words, stems and term weights.

A text is read by one task and its words are counted inside the row, so the shuffled rows are at most one per
distinct word of a text. Tables keyed by row id are hash partitioned on it once and stay so.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuvee.functions import text
from cuvee.functions.stem import stem_words
from cuvee.operators.scale import attach, fits_broadcast, hot_from, ordered_index
from cuvee.operators.stages import ParamEstimator, ParamTransformer, TableModel
from cuvee.runtime import materialize, ship_package
from cuvee.schema import KEY


def unnest(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per struct of an array. ``explode`` would make Catalyst test the array for emptiness below, and so
    compute it twice; the outer form with a test afterwards computes it once."""
    rows = df.select(*keep, F.explode_outer(column).alias("_t")).where(F.col("_t").isNotNull())
    return rows.select(*keep, "_t.*")


def description_tokens(df: DataFrame, column: str = "description", key: str = KEY) -> DataFrame:
    """(key, term, n): words of each text without stop words, before conflation."""
    counts = text.term_counts(text.content_words(F.col(column)))
    return unnest(df.select(key, counts.alias("terms")), "terms", key)


def stemmed(words: Column) -> Column:
    """The stems of an array of words, joined by a blank; empty if there is no word.

    Done where the rows are: a stem depends on its word alone, so a batch looks up its distinct words, and nothing is shuffled.
    """
    return F.arrow_udf(_stem_batch, "string")(words)


def _stem_batch(words: pa.Array) -> pa.Array:
    coded = words.flatten().dictionary_encode()
    stems = pa.array(stem_words(coded.dictionary.to_pylist()), pa.string()).take(coded.indices)
    length = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    ends = pa.array(np.append(0, np.cumsum(length)), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(ends, stems), " ").cast(pa.string())


def normalize_descriptions(df: DataFrame, column: str = "description", key: str = KEY) -> DataFrame:
    """(key, column): folded, without stop words, stemmed, words joined by a blank; empty if no word is left.

    One row per row of ``df``, so rows that share a key, or have none, keep their own words.
    """
    worded = df.select(key, text.content_words(F.col(column)).alias("_words"))
    return join_stems(worded).withColumnRenamed("_text", column)


def join_stems(words: DataFrame) -> DataFrame:
    """``words`` (_words, ...) with ``_text``: the stems joined by a blank, in place of the words."""
    ship_package(words.sparkSession)
    return words.withColumn("_text", stemmed(F.col("_words"))).drop("_words")


class TermCounter(ParamTransformer):
    """Adds one array of (source, term, n) over all text columns, counted inside the row."""

    outputCol = Param(Params._dummy(), "outputCol", "array of term counts", TypeConverters.toString)
    defaults = {"outputCol": "terms"}

    def _transform(self, df: DataFrame) -> DataFrame:
        def from_column(c: str):
            return lambda t: F.struct(F.lit(c).alias("source"), t["term"].alias("term"), t["n"].alias("n"))

        counts = [F.transform(text.term_counts(text.index_terms(F.col(c))), from_column(c)) for c in self.inputs]
        return df.withColumn(self.get("outputCol"), F.concat(*counts))


class HasTerms(Params):
    termsCol = Param(Params._dummy(), "termsCol", "output of TermCounter", TypeConverters.toString)
    sublinearCols = Param(
        Params._dummy(), "sublinearCols", "columns with damped term frequency", TypeConverters.toListString
    )
    keyCol = Param(Params._dummy(), "keyCol", "row id column", TypeConverters.toString)


def own_terms(column: str, sources: list[str]) -> Column:
    """The terms of some text columns; those of the others are left out before they are exploded or shuffled."""
    return F.filter(column, lambda t: t["source"].isin(sources)).alias(column)


class TermWeights(ParamEstimator, HasTerms):
    """TF-IDF of the text columns ``inputCols`` from their term counts.

    Term frequency is the count or, for columns in ``sublinearCols``, 1 + ln(count); idf is
    ln((1 + rows) / (1 + rows with the term)) + 1; every row of a column has length 1. Terms are numbered in sorted
    order per column. ``transform`` returns the long form (key, source, term_id, weight).
    """

    defaults = {"termsCol": "terms", "sublinearCols": [], "keyCol": KEY}

    def _fit(self, df: DataFrame) -> "TermWeightsModel":
        n = df.count()
        frequency = (
            unnest(df.select(own_terms(self.get("termsCol"), self.inputs)), self.get("termsCol"))
            .groupBy("source", "term")
            .agg(F.count(F.lit(1)).alias("df"))
        )
        positions = ordered_index(frequency, ["source", "term"], "position")
        spans = positions.groupBy("source").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("size"))
        found = {r["source"]: r for r in spans.collect()}
        sizes = {c: found[c]["size"] if c in found else 0 for c in self.inputs}
        start = F.create_map(*[F.lit(x) for c in found for x in (c, found[c]["first"])]) if found else F.lit(None)
        number = F.col("position") - (start[F.col("source")] if found else F.lit(0))
        vocabulary = materialize(
            positions.select(
                "source",
                "term",
                number.cast("int").alias("term_id"),
                "df",
                (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"),
            ),
            "vocabulary",
        )
        return TermWeightsModel().of(
            self, state={"small": fits_broadcast(vocabulary), "sizes": sizes}, vocabulary=vocabulary
        )


class TermWeightsModel(TableModel, HasTerms):
    table_names = ("vocabulary",)

    def packed(self, df: DataFrame) -> DataFrame:
        """(key, source, ids, weights): one row per text that has a known term, ids ascending.

        With a vocabulary that is broadcast the counts are partitioned by key first; exploding and the lookup keep that, so
        collecting the weights of a text needs no further shuffle.
        """
        key, terms = self.get("keyCol"), self.get("termsCol")
        counted = df.select(key, own_terms(terms, self.inputs))
        vocabulary, on = self.tables["vocabulary"], ["source", "term"]
        lookup = vocabulary.select(*on, "term_id", "idf")
        if self.state["small"]:
            joined = attach(unnest(counted.repartition(key), terms, key), lookup, on, [key], small=True)
        else:
            # Dealt out by term for the lookup and by key afterwards. Which terms are hot is known from the rows of the fit.
            joined = attach(unnest(counted, terms, key), lookup.hint("shuffle_hash"), on, [key], small=False, hot=self._hot())
        known = joined.where(F.col("term_id").isNotNull())
        n = F.col("n").cast("double")
        damped = F.col("source").isin(self.get("sublinearCols")) if self.get("sublinearCols") else F.lit(False)
        weight = F.when(damped, F.log(n) + 1).otherwise(n) * F.col("idf")
        grouped = known.withColumn("w", weight).groupBy(key, "source").agg(
            F.sort_array(F.collect_list(F.struct("term_id", "w"))).alias("cells"), F.sum(F.col("w") * F.col("w")).alias("square")
        )
        return grouped.select(
            key,
            "source",
            F.col("cells.term_id").alias("ids"),
            F.transform("cells", lambda c: c["w"] / F.sqrt("square")).alias("weights"),
        )

    def _hot(self) -> DataFrame:
        """(source, term) of the terms that many rows of the fit have: fewer than ``HOT_PARTS`` or one for each ``ROWS_PER_TASK`` rows."""
        frequency = self.tables["vocabulary"].where(F.col("source").isin(self.inputs))
        total = frequency.agg(F.sum("df")).first()[0] or 0
        return frequency.where(F.col("df") > hot_from(total)).select("source", "term")

    def _transform(self, df: DataFrame) -> DataFrame:
        key = self.get("keyCol")
        cells = self.packed(df).select(key, "source", F.arrays_zip("ids", "weights").alias("cells"))
        return unnest(cells, "cells", key, "source").withColumnsRenamed({"ids": "term_id", "weights": "weight"})
