"""Operators over DataFrames; entity, code and value columns are parameters."""
