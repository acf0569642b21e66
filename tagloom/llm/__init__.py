"""Operators for training-data pipelines, run on Spark DataFrames."""
