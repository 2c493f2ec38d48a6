"""Spark-native analytics for captured request/response records."""

__version__ = "0.1.0"
