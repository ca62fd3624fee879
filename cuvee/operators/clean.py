"""Cleaning of the raw review table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuvee.functions import text
from cuvee.schema import KEY, ROLES


def normalize_categories(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or [*ROLES.categorical, "designation"]
    return df.withColumns({c: text.normalize_category(F.col(c)) for c in columns})


def clean_titles(df: DataFrame) -> DataFrame:
    """Year from the raw title, then the title without numbers and place."""
    return df.withColumns({"year": text.title_year(F.col("title")), "title": text.clean_title(F.col("title"))})


def title_place_mismatch(df: DataFrame, key: str = KEY) -> DataFrame:
    """Titles whose bracket names none of province, region_1 and region_2; a missing region counts as different."""
    place = F.col("title_geo")
    others = ["province", "region_1", "region_2"]
    differs = [~place.eqNullSafe(F.col(c)) for c in others]
    return (
        df.select(key, text.title_place(F.col("title")).alias("title_geo"), *others)
        .where(place.isNotNull() & differs[0] & differs[1] & differs[2])
    )


def implication_violations(df: DataFrame, missing: str, present: str) -> DataFrame:
    """How many rows have ``present`` although ``missing`` is missing."""
    return df.agg(F.count_if(F.col(missing).isNull() & F.col(present).isNotNull()).alias("violations"))
