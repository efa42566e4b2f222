"""Operators for preparing training text, built on DataFrames and Arrow tasks."""
