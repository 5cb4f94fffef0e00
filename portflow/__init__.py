"""Vessel-position and port analytics on Spark DataFrames."""
