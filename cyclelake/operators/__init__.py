"""Batch operators, one module per area; every operator maps DataFrames to a DataFrame."""
