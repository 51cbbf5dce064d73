"""Operators for preparing training text: deduplication, search, scans, scoring, mixing, tokenizing.

Nothing else in the library imports this subpackage. Each operator module takes DataFrames and
returns lazy DataFrames; ``queries`` holds the thin registered queries.
"""
