"""Spark-native refinery for corpora of rich-text documents."""
