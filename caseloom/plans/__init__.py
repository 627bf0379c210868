"""Composed flows: feature tables, master matrix, training and scoring."""
