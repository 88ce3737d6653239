"""Analytic operators for season-style and event-style tables, on PySpark DataFrames."""
