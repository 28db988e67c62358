"""Spark-native set-coverage engine."""
