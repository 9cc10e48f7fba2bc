"""op5: SimHash fingerprints and components of near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.simhash import near_duplicates


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4, distance=4)


QUERIES = {"op5_simhash_near_dedup": op5_simhash_near_dedup}
ORACLES: dict[str, str] = {}
