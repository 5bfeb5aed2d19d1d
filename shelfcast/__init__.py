"""Hierarchical time-series features, forecasts, metrics and intervals on Spark DataFrames."""
