"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns DataFrames; the registered queries are in
``queries.py``.
"""
