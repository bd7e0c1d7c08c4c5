"""Spark-native analytics for finding overpriced records in tables and streams."""
