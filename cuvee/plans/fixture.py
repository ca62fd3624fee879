"""A review table derived from the driver tables, with the awkward cases built in.

Nulls, titles without a year, with a five digit number, with a bracket that names no region, double blanks, accents.
Every order is one review; parts and documents are dealt out to the orders in turn, so all of them are used.
``REVIEWS_SQL`` is the same table for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_REVIEWS = """
SELECT o.o_orderkey AS row_id,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE n.n_name END AS country,
       {description}
       CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE p.p_name END AS designation,
       CAST(80 + CAST(floor(o.o_totalprice) AS BIGINT) % 21 AS INT) AS points,
       CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE p.p_retailprice END AS price,
       r.r_name AS province,
       p.p_brand AS region_1,
       CASE WHEN o.o_orderkey % 2 = 0 THEN NULL ELSE p.p_type END AS region_2,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE c.c_mktsegment END AS taster_name,
       CASE WHEN o.o_orderkey % 5 = 0 OR o.o_orderkey % 7 = 0 THEN NULL
            ELSE '@' || lower(c.c_mktsegment) END AS taster_twitter_handle,
       CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
            ELSE CASE WHEN o.o_orderkey % 19 = 0 THEN '10000 ' ELSE '' END || 'Château ' || p.p_type
                 || CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE ' ' || CAST(year(o.o_orderdate) AS VARCHAR(4)) END
                 || '  ' || p.p_name || ' (' || CASE WHEN o.o_orderkey % 17 = 0 THEN 'Elsewhere' ELSE p.p_brand END || ')'
       END AS title,
       p.p_name AS variety,
       c.c_name AS winery
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
JOIN {part} p ON p.p_partkey = o.o_orderkey % {parts}
{documents_join}
"""
SMALL_TABLE = 256 * 1024 * 1024
_TABLES = ["orders", "customer", "nation", "region", "part"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_small(df: DataFrame, key: str) -> DataFrame:
    """The driver's tables are single files that only one task can read, however much work follows. A table known to
    be small is dealt out to all cores; anything larger comes in many splits and is left as it is."""
    spark = df.sparkSession
    read = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(spark.sparkContext.defaultParallelism, key) if read <= SMALL_TABLE else df


def reviews(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """The review table; without the text the documents are not read, and ``description`` is left out."""
    tables = {t: table(spark, sf_dir, t) for t in _TABLES}
    if with_text:
        tables["orders"] = spread_small(tables["orders"], "o_orderkey")
    sizes = {"parts": tables["part"].count()}
    description = join = ""
    if with_text:
        tables["documents"] = table(spark, sf_dir, "documents")
        sizes["docs"] = tables["documents"].count()
        description = "d.text AS description,"
        join = "JOIN {documents} d ON d.doc_id = o.o_orderkey % {docs}"
    query = _REVIEWS.replace("{description}", description).replace("{documents_join}", join)
    return spark.sql(query.replace("VARCHAR(4)", "STRING"), **tables, **sizes)


def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per document, for the text jobs: the whole text, its source and its language."""
    return spread_small(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("description"),
        F.concat_ws(" ", "source", "lang").alias("designation"),
    )


REVIEWS_SQL = _REVIEWS.format(
    description="d.text AS description,",
    documents_join="JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)",
    parts="(SELECT count(*) FROM part)",
    **{t: t for t in _TABLES},
)
REVIEWS_NO_TEXT_SQL = _REVIEWS.format(
    description="", documents_join="", parts="(SELECT count(*) FROM part)", **{t: t for t in _TABLES}
)
