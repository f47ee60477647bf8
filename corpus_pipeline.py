"""Training-data pipeline over ``documents``: every stage works on all rows its
predecessor kept and is written as Parquet before the next one reads it.

Defined results of ``run``: rows with null, empty or very short text are rejected
by the quality rules; very long texts are judged, compared and packed whole, cut
into pieces of the largest sequence; of repeated rows, exact and near copies one
row stays, also among rows that share an id or have none; an empty table gives no
rows; columns besides those of ``documents`` are carried along to the last stage,
whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utxoflow.llm import bpe, exact_dedup, jaccard, packing, quality_rules, secret_scan
from utxoflow.llm.common import staged, table


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are
    among them."""
    return quality_rules.drop_low_quality(docs)


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (white space apart) stays: the one
    with most code points, then with the smallest id."""
    return exact_dedup.drop_copies(docs)


def stage_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates stays; a text without words is a
    class of its own."""
    return jaccard.keep_one(docs)


def stage_secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every row stays, null texts null."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, cut into pieces where needed, packed into sequences by their
    byte-level BPE tokens; a row without tokens gets a row without a bin."""
    return packing.pack_documents(bpe.count_tokens(docs, name="__tokens"), length_col="__tokens")


STAGES = [
    ("quality rules", stage_quality_rules),
    ("exact dedup", stage_exact_dedup),
    ("n-gram jaccard join", stage_jaccard_join),
    ("secret scan", stage_secret_scan),
    ("best-fit packing", stage_packing),
]

#: No SQL: shingle joins and packing are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
