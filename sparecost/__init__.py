"""Quarterly parts-cost allocation on Spark DataFrames."""
