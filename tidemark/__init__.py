"""Tidemark: a PySpark-native lakehouse ingestion and table engine."""

__version__ = "0.1.0"
