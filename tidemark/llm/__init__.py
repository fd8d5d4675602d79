"""Operators of a training-data pipeline over document and page tables.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and parameters; the thin queries of :mod:`tidemark.llm.registry` bind them to
the driver's tables.
"""
