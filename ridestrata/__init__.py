"""Layered trip-data warehouse operators for Spark.

Every operator takes and returns Spark DataFrames; see README.md for the map
from operators to modules.
"""
