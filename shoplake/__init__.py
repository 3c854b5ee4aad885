"""Retail medallion analytics on plain Spark DataFrames: bronze landing, silver cleaning, gold star schema."""

__version__ = "0.1.0"
