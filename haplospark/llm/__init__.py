"""Operators of a training-data pipeline: formatting, scoring, deduplication, encoding."""
