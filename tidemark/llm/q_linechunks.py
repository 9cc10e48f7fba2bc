"""op8: removal of repeated chunks of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.linechunks import removal_digests


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), divisor=2)


QUERIES = {"op8_line_dedup": op8_line_dedup}
ORACLES = {
    "op8_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), h AS (
  SELECT doc_id, line, i, CAST('0x' || substring(md5(line), 1, 8) AS BIGINT) AS h FROM l
), r AS (
  SELECT doc_id, line, i,
         coalesce((h + 31 * lag(h) OVER w) // 65536 % 2, -1) AS r, max(i) OVER (PARTITION BY doc_id) AS n
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), p AS (
  SELECT r.*, phase FROM r, (SELECT unnest([0, 1]) AS phase)
), c AS (
  SELECT *, CASE WHEN i = n OR r = phase THEN 1 ELSE 0 END AS is_end FROM p
), k AS (
  SELECT *, coalesce(sum(is_end) OVER (PARTITION BY doc_id, phase ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM c
), ends AS (
  SELECT doc_id, phase, k, min(i) AS s, max(i) AS e FROM k GROUP BY 1, 2, 3
), spans AS (
  SELECT DISTINCT doc_id, s, e FROM ends
), listed AS (
  SELECT doc_id, list(line ORDER BY i) AS lines FROM l GROUP BY 1
), chunks AS (
  SELECT doc_id, s, e, array_to_string(lines[s:e], chr(10)) AS body FROM spans JOIN listed USING (doc_id) WHERE e > s
), ranked AS (
  SELECT doc_id, s, e, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM chunks
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(s, e)) AS i FROM ranked WHERE nth > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id
"""
}
