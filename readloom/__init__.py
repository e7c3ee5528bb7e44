"""Spark-native analytics for amplicon barcode reads and training-data tables."""

__version__ = "0.1.0"
