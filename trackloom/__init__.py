"""Spark-native quality engine for fixed-rate multi-sensor recordings."""
