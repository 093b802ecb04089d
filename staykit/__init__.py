"""staykit: Spark-native preparation of short-term-rental listing tables."""

__version__ = "0.1.0"
