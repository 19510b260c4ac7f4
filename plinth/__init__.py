"""Spark-native building conflation engine."""
