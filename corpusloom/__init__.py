"""Spark-native operators for text corpora, conversations and ordered chunk streams."""
