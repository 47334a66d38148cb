"""Operators for training-data pipelines: scoring, deduplication, archives, filters, extraction and packing."""
