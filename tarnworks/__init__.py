"""Watershed parameter engine on Spark DataFrames."""
