"""Spark-native news and document analytics engine."""
