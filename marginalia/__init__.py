"""marginalia: a PySpark-native engine for bibliographic and citation data."""

__version__ = "0.1.0"
