"""Weftline: analytics operators on Spark DataFrames."""
