"""Spark-native processing and querying of environmental sensor and sample data."""
