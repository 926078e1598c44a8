"""Spark-native lakehouse analytics: ingest, clean, profile, features, models, evaluation."""
