"""Operators over documents, pages and vectors for preparing training data.

Nothing else in the library imports this package. Each module holds one operator with its own
interface; `queries.py` applies them to the given tables.
"""
