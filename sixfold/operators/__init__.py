"""Reusable operators: every one takes DataFrames and column names and returns a lazy DataFrame."""
