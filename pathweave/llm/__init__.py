"""Operators for training-data pipelines: deduplication, filtering, tokenizing, packing, search."""
