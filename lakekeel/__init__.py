"""Incremental lakehouse analytics on Spark DataFrames."""
