"""A Spark-native analytics engine for large collections of parsed legal documents."""

__version__ = "0.1.0"
