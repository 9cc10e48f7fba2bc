"""op2: removal of word windows that an earlier document has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.substrings import removal_digests


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=50)


QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLES = {
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), starts AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS p, w FROM d WHERE len(w) >= 50
), hashed AS (
  SELECT doc_id, p, sha256(array_to_string(w[p:p+49], ' ')) AS h FROM starts
), repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS low FROM hashed) WHERE doc_id > low
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(p, p + 49)) AS p FROM repeated
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d
), kept AS (
  SELECT k.doc_id, count(*) AS n, string_agg(k.word, ' ' ORDER BY k.p) AS body
  FROM words k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.p = g.p
  WHERE g.p IS NULL GROUP BY k.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
}
