"""Spark-native mining of text-bearing images out of sharded caption tables."""
