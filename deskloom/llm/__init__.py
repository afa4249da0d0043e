"""Operators for training-data pipelines: deduplication, quality, safety, mixing and token output."""
