"""Spark-native analytics over recorded multi-sensor episodes."""

__version__ = "0.1.0"
