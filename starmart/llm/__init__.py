"""Operators of a training-data pipeline over a table of documents.

Nothing else in the library imports this subpackage. Each operator picks the
columns it needs by name and returns its documented columns only, so extra
columns of the input, whatever their names, cannot clash with its own.
"""
