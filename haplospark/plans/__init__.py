"""Whole reports, and the same operators run on the benchmark tables."""
