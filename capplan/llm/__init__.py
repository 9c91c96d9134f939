"""Operators for preparing training text: deduplication, filtering, extraction, formatting, packing.

Nothing else in the library imports this package.
"""
