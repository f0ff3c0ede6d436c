"""Batch operators: each takes and returns DataFrames."""
