"""Preparing, profiling, checking and modelling flat tables with Spark DataFrames."""

__version__ = "0.1.0"
