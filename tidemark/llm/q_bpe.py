"""op4: token ids of every document and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe import round_trip


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op4_bpe_round_trip": op4_bpe_round_trip}
ORACLES: dict[str, str] = {}
