"""Cohort feature analytics on Spark DataFrames."""
