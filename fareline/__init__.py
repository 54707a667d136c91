"""Spark-native analytics for urban taxi mobility data."""
