"""Layered city-data loading and marts on Spark DataFrames."""
