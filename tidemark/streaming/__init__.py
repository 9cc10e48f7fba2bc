"""Incremental and streaming refresh; each job has a batch twin."""
