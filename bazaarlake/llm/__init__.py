"""Operators of a training-data pipeline: sharding, mixing, screening, near duplicates, search."""
