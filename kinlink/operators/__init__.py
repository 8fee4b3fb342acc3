"""Operators of the linkage pipeline; each takes and returns DataFrames."""
