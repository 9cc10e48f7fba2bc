"""Queries and the metric registry built from the operators."""
