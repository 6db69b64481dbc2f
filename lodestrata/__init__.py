"""Lodestrata: a Spark-native engine for literature extraction and corpus work."""
