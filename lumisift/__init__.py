"""Lumisift: a PySpark-native engine for label quality and training-data curation."""
