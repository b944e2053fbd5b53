"""Retail star-schema loading, checking and reporting on Spark DataFrames."""

__version__ = "0.1.0"
