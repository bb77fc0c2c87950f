"""Listening analytics and recommendations on PySpark DataFrames."""
