"""Operators of a training-data pipeline, each on DataFrames, and their registered queries."""
