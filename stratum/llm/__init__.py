"""Operators of a training-data pipeline over large text tables.

One module per operator; ``queries`` binds them to the driver tables and holds
their DuckDB statements.  Nothing outside this subpackage imports it.
"""
