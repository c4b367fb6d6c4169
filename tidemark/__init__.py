"""Reusable analytics and data-engineering operators for Spark DataFrames."""
