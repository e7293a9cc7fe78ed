"""Operators: each takes DataFrames and gives a lazy DataFrame."""
