"""Spark-native analytics over Parquet tables."""
