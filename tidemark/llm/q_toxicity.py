"""op6: toxicity scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.toxicity import THRESHOLD, held_out_rows, scores


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), parts=4, held=2)
    held = F.coalesce(held_out_rows(F.col("doc_id"), 4, 2), F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLES: dict[str, str] = {}
