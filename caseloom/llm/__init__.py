"""Operators for preparing text as training data, and their registered queries."""
