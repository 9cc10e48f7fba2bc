"""op13: periodic runs in all documents, every tenth of which is made periodic first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.periodic import periodic_runs


def planted(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text; where crc32 of the id ends in 0, its words from a on repeat with period p."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w):
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        whole = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), F.slice(whole, F.lit(1), (n - a).cast("int"))), " "))

    # The lambda holds the words, so that they are split once.
    changed = F.transform(F.array(words), repeated)[0]
    return F.when((F.pmod(h, F.lit(10)) == 0) & F.col(text).isNotNull(), F.coalesce(changed, F.col(text))).otherwise(F.col(text))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", planted().alias("text"))
    found = periodic_runs(docs, least=12, times=2)
    longest = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("below"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.withColumn("best", F.get(longest, F.lit(0)))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.below")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-F.col("best.below") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
ORACLES = {
    "op13_periodic_runs": r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [0, 1, 2, 3, 4, 5, 6, 7]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h
  FROM documents, crc
), sized AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CASE WHEN len(w) > 0 THEN h // 10 % len(w) END AS a FROM split
), placed AS (
  SELECT *, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM sized
), docs AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(w[1:a], list_transform(range(a, n), lambda i: w[a + (i - a) % p + 1])) ELSE w END AS w FROM placed
), at_ AS (
  SELECT doc_id, n, w, unnest(range(0, n - 5)) AS i FROM docs WHERE n >= 12
), grams AS (
  SELECT doc_id, n, i, md5(array_to_string(w[i + 1:i + 6], ' ')) AS g FROM at_
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pairs
), stretches AS (
  SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e FROM islands GROUP BY doc_id, q, k
), runs AS (
  SELECT doc_id, s, e - s AS length, min(q) AS q FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    min(row(-length, s, q)) AS best FROM runs GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM runs
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM docs
), kept AS (
  SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.i) AS body FROM words k LEFT JOIN gone g ON k.doc_id = g.doc_id AND k.i = g.i WHERE g.i IS NULL GROUP BY k.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, CAST(l.best[2] AS BIGINT) AS start, CAST(-l.best[1] AS BIGINT) AS length, CAST(l.best[3] AS BIGINT) AS period,
  CAST(1000 * -l.best[1] // l.best[3] AS BIGINT) AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.body, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
}
