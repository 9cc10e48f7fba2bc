"""op1: Merkle fingerprints of documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.merkle import SPAN, edits


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _tree(text: str, name: str) -> str:
    return f"""
  list_transform(string_split({text}, chr(10)), lambda p: sha256(p) || CASE WHEN trim(p, ' ') = '' THEN '|' ELSE '' END) AS {name}_p,
  string_split({text}, chr(10)) AS {name}_l"""


def _sections(name: str) -> str:
    return f"""list_transform(list_filter(string_split(array_to_string(list_transform({name}_p,
    lambda d: CASE WHEN regexp_matches(d, '^[0-3]|\\|$') THEN rtrim(d, '|') || '|' ELSE d END), ''), '|'),
    lambda g: g <> ''), lambda g: sha256(g)) AS {name}_g"""


def _branches(name: str) -> str:
    """Each section's digest and its paragraphs, with marks at the ends of sections and paragraphs."""
    cut = f"""array_to_string(list_transform(list_zip({name}_l, {name}_p), lambda z: replace(z[1], chr(1), chr(1) || 'a') ||
    CASE WHEN regexp_matches(z[2], '^[0-3]|\\|$') THEN chr(1) || 'b' ELSE chr(1) || 'c' END), '')"""
    return f"list_transform(list_zip({name}_g, string_split({cut}, chr(1) || 'b')[1:len({name}_g)]), lambda z: z[1] || z[2]) AS {name}_b"


def _only(a: str, b: str) -> str:
    return f"list_filter(list_distinct({a}), lambda x: NOT list_contains({b}, x))"


def _lines(branches: str) -> str:
    return f"list_distinct(flatten(list_transform({branches}, lambda x: string_split(substring(x, 65), chr(1) || 'c'))))"


def _spans(lines: str) -> str:
    return f"list_distinct(flatten(list_transform({lines}, lambda p: regexp_extract_all(p, '{SPAN}'))))"


def _total(values: str, kept: int = 0) -> str:
    return f"coalesce(list_sum(list_transform({values}, lambda s: length(s) - {kept})), 0)"


def _like(a: str, b: str, pair: str) -> str:
    shared = f"({_total(f'list_intersect(list_distinct({a}_b), list_distinct({b}_b))', 64)} + {_total(f'list_intersect({pair}_1, {pair}_2)')} + {_total(f'list_intersect({pair}_3, {pair}_4)')})"
    every = f"({_total(f'list_intersect(list_distinct({a}_b), list_distinct({b}_b))', 64)} + {_total(f'list_intersect({pair}_1, {pair}_2)')} + {_total(f'list_distinct(list_concat({pair}_3, {pair}_4))')})"
    return f"CASE WHEN array_to_string({a}_g, '') = array_to_string({b}_g, '') THEN 1.0::DOUBLE WHEN {every} = 0 THEN 0.0::DOUBLE ELSE {shared}::DOUBLE / {every}::DOUBLE END"


QUERIES = {"op1_document_fingerprints": op1_document_fingerprints}
ORACLES = {
    "op1_document_fingerprints": f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), n AS (
  SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id, t), first_value(t) OVER (ORDER BY doc_id, t)) AS nt FROM d
), e AS (
  SELECT doc_id, t, nt, substring(t, 1, length(t) - length(t) // 4) || substring(nt, 1, length(t) // 4) AS et FROM n
), trees AS (
  SELECT doc_id, t, et, {_tree('t', 'a')}, {_tree('et', 'b')}, {_tree('nt', 'c')} FROM e
), g AS (
  SELECT *, {_sections('a')}, {_sections('b')}, {_sections('c')} FROM trees
), h AS (
  SELECT *, {_branches('a')}, {_branches('b')}, {_branches('c')} FROM g
), lines AS (
  SELECT *, {_lines(_only('a_b', 'b_b'))} AS e_1, {_lines(_only('b_b', 'a_b'))} AS e_2, {_lines(_only('a_b', 'c_b'))} AS n_1, {_lines(_only('c_b', 'a_b'))} AS n_2 FROM h
), spans AS (
  SELECT *, {_spans(_only('e_1', 'e_2'))} AS e_3, {_spans(_only('e_2', 'e_1'))} AS e_4, {_spans(_only('n_1', 'n_2'))} AS n_3, {_spans(_only('n_2', 'n_1'))} AS n_4 FROM lines
)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(et) AS edited_sha256,
  sha256(array_to_string(a_g, '')) AS fingerprint, sha256(array_to_string(b_g, '')) AS edited_fingerprint,
  {_like('a', 'b', 'e')} AS near_edited, {_like('a', 'c', 'n')} AS near_next,
  CAST(len(a_p) AS BIGINT) AS n_paragraphs, CAST(len(a_g) AS BIGINT) AS n_sections,
  CAST(len(list_filter(list_distinct(b_g), lambda x: NOT list_contains(a_g, x))) AS BIGINT) AS changed_sections,
  CAST(len(list_filter(list_distinct(b_p), lambda x: NOT list_contains(a_p, x))) AS BIGINT) AS changed_paragraphs,
  CAST(coalesce(list_position(list_transform(generate_series(1, greatest(len(a_p), len(b_p))),
       lambda i: a_p[i] IS NOT DISTINCT FROM b_p[i]), false), 0) AS BIGINT) AS first_changed
FROM spans
"""
}
