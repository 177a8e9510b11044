"""Operators for training-data pipelines: deduplication, tokenising, extraction, filtering, search and packing."""
