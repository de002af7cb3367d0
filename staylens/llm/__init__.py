"""Operators for large training-data pipelines, one module per operator.

Each operator is a function from DataFrames to a DataFrame with its own
parameters. `queries` applies every operator to its table with production
parameters and `oracle` holds the DuckDB SQL where SQL can express it.
"""
