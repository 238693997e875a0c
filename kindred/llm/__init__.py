"""Operators for training-data pipelines: packing, deduplication, scans, scoring, files."""
