"""Core operators: each takes and returns DataFrames."""
