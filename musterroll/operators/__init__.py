"""Operators on DataFrames, one concern per module."""
