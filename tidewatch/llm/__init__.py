"""Operators of a training-data pipeline: deduplication, scoring, filtering, mixing, packing.

Every operator takes DataFrames and column names, selects only the columns it
uses (so further columns, whatever their names, do no harm) and returns a
DataFrame.  Nothing outside this package imports it.
"""
