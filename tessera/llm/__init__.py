"""Operators of a training-data pipeline over a ``documents`` table.

Each module holds one operator with its own general interface (column names
and thresholds are parameters); ``registry`` holds the thin ``opN_<name>``
queries.  Nothing outside this package imports it.
"""
