"""Spark-native operators for building, screening and packing text corpora."""
