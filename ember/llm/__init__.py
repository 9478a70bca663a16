"""Operators for large training-data pipelines: one module per operator.

Every module offers a general operator (DataFrames in, DataFrames out) and
states its null, empty and tie rules; ``catalog`` holds the registered thin
queries and ``oracles`` their DuckDB SQL.
"""
