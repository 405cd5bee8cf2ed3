"""The data models, each a function from DataFrames to a DataFrame."""
