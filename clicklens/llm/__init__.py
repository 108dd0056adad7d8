"""Operators of a training-data pipeline: quality, duplicates, sharding,
tokenizing, packing, secrets and page text."""
