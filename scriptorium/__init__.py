"""Spark-native engine that turns text corpora into audited training datasets."""

__version__ = "0.1.0"
