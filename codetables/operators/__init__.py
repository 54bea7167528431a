"""Operators on DataFrames: relations, summaries, versions, carrying forward, checks."""
