"""op9: pages to WARC archives and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.warc import round_trip


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), least=1_000)


QUERIES = {"op9_warc_round_trip": op9_warc_round_trip}
ORACLES = {
    "op9_warc_round_trip": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest, coalesce(html, '') AS html FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
"""
}
