"""Spark-native building, maintenance and auditing of document archives."""

__version__ = "0.1.0"
