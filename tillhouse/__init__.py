"""Tillhouse: a restaurant-chain sales lakehouse written as Spark DataFrames."""
