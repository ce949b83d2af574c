"""Gleaner: retrieval, retrieval evaluation and document analytics as Spark DataFrames."""

__version__ = "0.1.0"
