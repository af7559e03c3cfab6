"""Delivery-operations analytics on Spark DataFrames."""
