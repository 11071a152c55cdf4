"""Incremental ingest of results folders."""
