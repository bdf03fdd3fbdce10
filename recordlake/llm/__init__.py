"""Operators for training-data pipelines: duplicates, scoring, mixing, token output, filters."""
