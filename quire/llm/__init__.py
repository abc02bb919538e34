"""Operators for large training-data pipelines, one module per operator.

`queries.QUERIES` holds the registered queries and `queries.SQL` their DuckDB
counterparts. Nothing outside this subpackage imports it.
"""
