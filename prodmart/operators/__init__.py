"""Keyed, ordered, versioned and checking operators over DataFrames."""
