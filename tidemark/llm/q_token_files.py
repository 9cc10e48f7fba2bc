"""op11: token ids of all documents in ORC files, read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import shared_folder
from tidemark.llm.token_files import checksums, read_ids, write_ids


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-ids")
    write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    return checksums(read_ids(spark, folder))


QUERIES = {"op11_token_files": op11_token_files}
ORACLES: dict[str, str] = {}
