"""Spark-native knowledge-graph retrieval engine: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
