"""Operators: DataFrames in, DataFrames out, nothing collected to the driver."""
