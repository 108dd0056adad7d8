"""Readers of logs and lookups, writers of results, staging tables."""
