"""PySpark-native curation of grouped record collections and tree tables."""

__version__ = "0.1.0"
