"""Waiting-list analytics on Spark DataFrames."""
