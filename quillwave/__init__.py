"""Spark-native preparation of speech and text training data."""
