"""Ledger and market-metrics analytics expressed as Spark jobs."""
