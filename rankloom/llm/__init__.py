"""Operators of a training-data pipeline over large document tables.

Every operator takes DataFrames and selects the columns that it names, so further columns of any
name do no harm. Nothing outside this subpackage imports it.
"""
