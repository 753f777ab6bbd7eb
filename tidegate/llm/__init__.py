"""Operators of a training-data pipeline: dedup, mixing, filtering, scoring, tokenising and extraction.

Nothing outside this package imports it.
"""
