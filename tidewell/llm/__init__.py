"""Operators that prepare training corpora: cleaning, deduplication, mixing and packing of documents.

Every operator takes DataFrames and names its columns by parameter, selects those columns first (other
columns, whatever their names, never reach it) and states in its docstring what nulls, empty texts,
repeated rows and empty tables give.
"""
