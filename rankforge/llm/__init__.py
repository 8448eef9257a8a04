"""Operators for training-data pipelines: token files, packing, scoring, archives, filters and deduplication."""
