"""Weftline: a PySpark-native analytics engine for transcript and document corpora."""

__version__ = "0.1.0"
