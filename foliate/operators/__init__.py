"""Relational stages: each takes DataFrames and returns DataFrames."""
