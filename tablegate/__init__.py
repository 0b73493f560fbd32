"""Data-validation engine for version-history tables, built on Spark DataFrames."""

__version__ = "0.1.0"
