"""Trend analytics over public code-hosting activity, on Spark DataFrames."""
