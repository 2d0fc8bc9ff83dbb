"""Operators: functions from DataFrames and column names to a DataFrame."""
