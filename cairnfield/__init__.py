"""Gridded time series, and the objects found in them, as Spark DataFrames."""
