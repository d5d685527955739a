"""Spark-native engine for the data side of language-model post-training."""

__version__ = "0.1.0"
