"""op12: conversations that were damaged on purpose, repaired at the least cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.conversations import repair


def damaged(rows: DataFrame) -> DataFrame:
    """Rows by crc32 of `conv_id:turn`: 0 drops one (it stays as not present), 1 empties its text, 2 takes its sentence
    ends, 3 repeats it, 4 makes it the user's; nulls are read as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")), F.lit(20))
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    text = F.when(F.col("fault").isin(0, 1), "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), copies.alias("_copy")).drop("_copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), present="present").drop("repaired")


def _more(state: str, cost, letter: str) -> str:
    """A state's best edits (six digits of cost, then the audit) and one more; null stays null."""
    return f"lpad(CAST(CAST(substr({state}, 1, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({state}, 7) || '{letter}'"


def _inserted(source: str) -> str:
    """States from n0 to n3 of a query, with up to two insertions."""
    once = f"SELECT *, least(n2, {_more('n0', 5, 'I')}, {_more('n1', 5, 'I')}, {_more('n3', 5, 'I')}) AS u, least(n3, {_more('n2', 5, 'I')}) AS a FROM ({source})"
    return f"SELECT conv_id, i, n0 AS s0, n1 AS s1, least(u, {_more('a', 5, 'I')}) AS s2, least(a, {_more('u', 5, 'I')}) AS s3 FROM ({once})"


def _edited() -> str:
    """States after one more row: deleted, kept where its initial fits, or with another role."""
    kept, extra = "f.fault NOT IN ('b', 'd')", "CASE WHEN f.fault = 't' THEN 5 ELSE 0 END"
    keep = lambda s: _more(s, extra, "K")
    other = lambda s: _more(s, f"1 + {extra}", "R")
    return f"""SELECT f.conv_id, f.i, {_more('s0', 2, 'D')} AS n0,
      least({_more('s1', 2, 'D')}, CASE WHEN {kept} AND f.c = 's' THEN {keep('s0')} END) AS n1,
      least({_more('s2', 2, 'D')}, CASE WHEN {kept} THEN least({other('s0')}, {other('s1')}, {other('s3')}) END,
        CASE WHEN {kept} AND f.c = 'u' THEN least({keep('s0')}, {keep('s1')}, {keep('s3')}) END) AS n2,
      least({_more('s3', 2, 'D')}, CASE WHEN {kept} THEN {other('s2')} END, CASE WHEN {kept} AND f.c = 'a' THEN {keep('s2')} END) AS n3
    FROM steps s JOIN faults f ON f.conv_id = s.conv_id AND f.i = s.i + 1"""


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES = {
    "op12_conversation_repair": rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [0, 1, 2, 3, 4, 5, 6, 7]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS k
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS c FROM damaged
), faults AS (
  SELECT *, lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS next_c,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault
  FROM placed
), counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (next_c IS NOT NULL AND c || next_c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), steps AS (
  {_inserted("SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS n0, CAST(NULL AS VARCHAR) AS n1, CAST(NULL AS VARCHAR) AS n2, CAST(NULL AS VARCHAR) AS n3 FROM counts")}
  UNION ALL
  {_inserted(_edited())}
), best AS (
  SELECT c.conv_id, CAST(substr(least(s0, s3), 1, 6) AS BIGINT) AS cost, substr(least(s0, s3), 7) AS audit FROM counts c JOIN steps s ON s.conv_id = c.conv_id AND s.i = c.n
), applied AS (
  SELECT conv_id, audit, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(NULL AS VARCHAR) AS body FROM best
  UNION ALL
  SELECT conv_id, audit, k, i, state, CASE WHEN line IS NULL THEN body WHEN body IS NULL THEN line ELSE body || chr(10) || line END FROM (
    SELECT a.conv_id, a.audit, a.k + 1 AS k, a.i + CASE WHEN e = 'I' THEN 0 ELSE 1 END AS i, a.body,
      CASE e WHEN 'D' THEN a.state WHEN 'K' THEN CASE f.c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE WHEN a.state = 2 THEN 3 ELSE 2 END END AS state,
      CASE e WHEN 'D' THEN NULL WHEN 'K' THEN f.role || ':' || f.text ELSE CASE WHEN a.state = 2 THEN 'assistant:' ELSE 'user:' END || CASE WHEN e = 'R' THEN f.text ELSE '' END END AS line
    FROM (SELECT *, substr(audit, k + 1, 1) AS e FROM applied WHERE k < length(audit)) a LEFT JOIN faults f ON f.conv_id = a.conv_id AND f.i = a.i + 1)
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(a.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id = o.conv_id LEFT JOIN best b ON b.conv_id = o.conv_id
LEFT JOIN applied a ON a.conv_id = o.conv_id AND a.k = length(a.audit)
"""
}
