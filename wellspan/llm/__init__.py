"""Operators for large training-data pipelines (mixing, filtering, deduplication, sharding).

Nothing outside this subpackage imports it.  Every operator takes a DataFrame plus column names,
reads only the columns it names (extra columns, whatever they are called, never clash) and states
in its docstring what nulls, empty texts, ties, repeated rows and empty tables give.
"""
