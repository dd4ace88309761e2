"""Spark-native analytics over threaded discussion corpora."""
