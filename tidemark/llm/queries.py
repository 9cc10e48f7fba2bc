"""The registered queries op1 to op13 and their oracle SQL."""

from __future__ import annotations

from tidemark.llm import q_bpe, q_conversations, q_linechunks, q_merkle, q_mixing, q_ngram, q_periodic, q_simhash, q_substrings, q_token_files, q_topk, q_toxicity, q_warc

MODULES = [q_merkle, q_substrings, q_ngram, q_bpe, q_simhash, q_toxicity, q_mixing, q_linechunks, q_warc, q_topk, q_token_files, q_conversations, q_periodic]

QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: sql for m in MODULES for k, sql in m.ORACLES.items()}
