"""Operators of a training-data pipeline: filters, near-duplicate search, mixing, sharding.

Every operator is a function from DataFrames to a DataFrame; `queries` binds
each to its table with production parameters.
"""
