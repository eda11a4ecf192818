"""Demand, supply and pricing analytics for order data, built on Spark DataFrames."""
