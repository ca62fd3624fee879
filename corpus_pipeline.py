"""From raw documents to packed training sequences: toxic documents go, near copies go, benchmark leaks go, secrets are
masked, and what is left is packed.

A stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` stores what each returns and hands the stored table on, so
a lost executor costs at most one stage.

Cases: the stages take any columns beside doc_id and text and hand them on; null texts, null ids and empty tables pass. Of rows
that share an id the near-duplicate stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuvee.llm import decontaminate, near_dups, packing, queries, secret_scan, toxicity
from cuvee.llm.common import keep_columns, one_row_per_id
from cuvee.runtime import discard, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = queries.toxicity_model(spark, sf_dir, docs)
    return toxicity.score(docs, model, name="_toxicity").where(F.col("_toxicity") < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    found = near_dups.near_duplicates(docs)
    copies = materialize(found.where(~F.col("kept")).select("doc_id"), "copies")
    return keep_columns(one_row_per_id(docs), copies)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))
    leaks = materialize(found.where(F.col("contaminated")).select("doc_id"), "leaks")
    return keep_columns(docs, leaks)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The secrets of a text are masked, and its n_chars follows; every document stays."""
    found = materialize(queries.secret_findings(spark, docs), "findings")
    masked = secret_scan.redact(docs, found)
    if "n_chars" in docs.columns and found.limit(1).count():
        kind = dict(docs.dtypes)["n_chars"]
        hidden = F.col("text").contains(secret_scan.Settings().mask)
        masked = masked.withColumn("n_chars", F.when(hidden, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Training and tokenizers are beyond SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        read, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(read)  # nothing reads it any more; the given table isn't one of ours and stays
    return docs
