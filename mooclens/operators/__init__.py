"""Report operators: pure functions from DataFrames to a DataFrame."""
