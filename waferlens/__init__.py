"""Spark-native root-cause analysis for manufacturing data."""
