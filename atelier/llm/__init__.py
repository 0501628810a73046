"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage.  Each operator takes
DataFrames and returns a DataFrame; ``registry`` holds the thin queries that
apply them to the driver's tables.
"""
