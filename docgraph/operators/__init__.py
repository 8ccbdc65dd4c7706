"""Operators: functions from DataFrames to DataFrames, without driver-side work."""
