"""Names, types and roles of the review table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEY = "row_id"
LABEL = "points"
MISSING = "_missing_"
POOLED = "_other_"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(KEY, T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("designation", T.StringType()),
        T.StructField(LABEL, T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("province", T.StringType()),
        T.StructField("region_1", T.StringType()),
        T.StructField("region_2", T.StringType()),
        T.StructField("taster_name", T.StringType()),
        T.StructField("taster_twitter_handle", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("variety", T.StringType()),
        T.StructField("winery", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Roles:
    """Which column plays which part.

    The twitter handle has no part: it is missing whenever the taster is, and otherwise repeats the taster.
    """

    numeric: list[str] = field(default_factory=lambda: ["year", "price"])
    categorical: list[str] = field(
        default_factory=lambda: ["country", "province", "region_1", "region_2", "taster_name", "variety", "winery"]
    )
    text: list[str] = field(default_factory=lambda: ["designation", "description", "title"])
    key: str = KEY
    label: str = LABEL
    #: The numeric column that the evaluation tables report, and the category with a pooling threshold of its own.
    price: str = "price"
    sparse: str = "winery"

    @property
    def needed(self) -> list[str]:
        return [self.key, self.label, *self.numeric, *self.categorical, *self.text]


ROLES = Roles()
