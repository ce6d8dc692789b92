"""Operators of a training-data pipeline: filters, dedup, privacy, packing, archives.

Nothing else in the package imports this folder. Every operator takes DataFrames and
returns DataFrames; ``queries`` registers one query for each.
"""
