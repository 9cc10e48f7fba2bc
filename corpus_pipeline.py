"""The corpus pipeline: documents through five operators, each stage written and read again before the next.

Toxic documents go, repeated chunks of lines are cut out, one document of each group of near-duplicates stays, the
sources are mixed to their target weights, and what is left is encoded. All stages but the last return the columns of
documents; each works on all rows that the one before it kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, linechunks, mixing, simhash, toxicity
from tidemark.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold of op6."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scores(docs, labels, out="_score").where(F.col("_score") < toxicity.THRESHOLD).select(*COLUMNS)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; a document of which nothing is left goes, a null text stays null."""
    # The partition number in the condition keeps the optimizer from copying the chunks' expressions into the filter.
    found = linechunks.remove_repeated_lines(docs).withColumn("_at", F.spark_partition_id())
    found = found.where(((F.col("kept_text") != "") | (F.col("n_removed") == 0)) & (F.col("_at") >= 0))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more."""
    return simhash.one_of_alike(docs, shingle=5, similarity=0.8).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs).select(*COLUMNS)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of what they decode to."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Neither the classifier nor XXH64 nor BPE can be written in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
