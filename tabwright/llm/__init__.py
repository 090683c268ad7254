"""Operators of a training-data pipeline: quality, duplicates, leaks, personal data, pages and tokens.

Nothing else in the library imports this subpackage.
"""
