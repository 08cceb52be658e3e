"""Spark-native reshaping, mart building and analysis of published statistics tables."""
