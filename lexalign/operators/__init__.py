"""Operators: each takes and returns DataFrames; nothing is collected."""
