"""op7: how much of each document a mix of the sources takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.mixing import mix


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), weights=(1, 2, 3), most=3, seed=0)


QUERIES = {"op7_mix_sources": op7_mix_sources}
ORACLES = {
    "op7_mix_sources": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('0:' || CAST(doc_id AS VARCHAR)) AS k
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS n
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE
              - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * source_size / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM totals
), flagged AS (
  SELECT *, w * rest >= 3 * source_size * weights AS is_full FROM ordered
), goal AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE
              ELSE w * (SELECT max(rest) FROM flagged WHERE NOT is_full) / (SELECT max(weights) FROM flagged WHERE NOT is_full) END AS target
  FROM flagged
), running AS (
  SELECT s.doc_id, s.size, g.source_size, g.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS before_it,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS rounds
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       CAST(rounds * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - rounds * source_size - before_it)) AS BIGINT) AS taken
FROM running
"""
}
