"""Operators on tables of measurements: DataFrame in, DataFrame out."""
