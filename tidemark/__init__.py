"""Spark-native medallion and text-derivation engine."""
