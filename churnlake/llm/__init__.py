"""Operators for large training-data pipelines: dedup, filters, mixing, sharding, encoding."""
