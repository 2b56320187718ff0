"""Loomwick: a Spark-native engine for content ingest and transcript analytics."""
