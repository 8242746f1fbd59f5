"""Operators for training-data pipelines: deduplication, filtering, scanning, encoding, packing."""
