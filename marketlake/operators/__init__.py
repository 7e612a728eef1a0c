"""Operators: pure functions of DataFrames and parameters."""
