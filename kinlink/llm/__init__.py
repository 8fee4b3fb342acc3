"""Operators for preparing training data, each usable on its own.

Nothing outside this package imports it.  Every operator's module documents what
it returns for nulls, empty tables, repeated rows, ties, long texts and columns
whose names clash with its own.
"""
