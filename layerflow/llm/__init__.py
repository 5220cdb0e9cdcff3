"""Operators of a large-scale training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames, works on whole texts and on all rows, and has a fixed result
for null, empty and very long texts, repeated rows, empty tables and extra
columns (each module's docstring states it). ``queries.py`` registers them.
"""
