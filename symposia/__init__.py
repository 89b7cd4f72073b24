"""Spark-native analytics over question-and-answer discourse and the knowledge graph drawn from it."""

__version__ = "0.1.0"
