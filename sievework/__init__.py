"""sievework: a Spark-native engine that turns web pages and text tables into training corpora."""

__version__ = "0.1.0"
