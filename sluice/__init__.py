"""Spark-native ingestion and loading toolkit."""

__version__ = "0.1.0"
