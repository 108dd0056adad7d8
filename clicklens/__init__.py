"""Clickstream analytics as PySpark DataFrame operators."""
