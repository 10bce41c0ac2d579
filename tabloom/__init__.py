"""Tabular profiling, feature preparation and binary classification on PySpark DataFrames."""

__version__ = "0.1.0"
