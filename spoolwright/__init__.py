"""Spoolwright: a Spark-native engine for media and text corpora."""
