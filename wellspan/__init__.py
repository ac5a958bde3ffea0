"""Spark-native analytics for high-content-screening image data."""
