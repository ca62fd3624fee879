"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.operators.scale import fits_broadcast
from cuvee.runtime import materialize, ship_package

#: Measured bytes up to which a side is broadcast; beyond it the same join runs by shuffle.
BROADCAST_BYTES = 16 * 1024 * 1024


def sized(table: DataFrame) -> DataFrame:
    """``table`` for a join: marked for broadcast only if its measured size allows it.

    ``table`` should be a stored one, since measuring reads it.
    """
    return F.broadcast(table) if fits_broadcast(table, BROADCAST_BYTES) else table


#: Rows of an Arrow batch that holds whole texts. Spark's default of 10,000 is meant for rows of numbers: with texts a task keeps
#: that many of them on both sides of the pipe, and its buffers double as they grow.
TEXT_ROWS = 1000


def to_python(spark: SparkSession) -> None:
    """Before texts go to Python workers: ship the package, and keep batches small unless they are set smaller already."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= TEXT_ROWS:
        spark.conf.set(rows, str(TEXT_ROWS))


def give_back() -> None:
    """At the end of a task: hand back memory that Arrow and the C library keep for later, since workers stay for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim:
        trim(0)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keep_columns(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose key is in the stored table ``dropped``; rows without a key stay."""
    return docs.join(sized(dropped.select(key)), key, "left_anti").select(*docs.columns)


def one_row_per_id(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of those that share an id; rows without an id all stay. Only repeated ids are shuffled."""
    repeated = materialize(
        docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).select(key),
        "repeated",
    )
    if not repeated.limit(1).count():
        return docs
    one = docs.join(sized(repeated), key, "left_semi").dropDuplicates([key])
    return docs.join(sized(repeated), key, "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))
