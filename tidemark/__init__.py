"""Tabular data preparation, profiling, reconciliation and imputation on PySpark DataFrames."""
