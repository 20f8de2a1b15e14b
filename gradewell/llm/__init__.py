"""Operators for preparing training text: filters, deduplication, scoring, formatting and mixing.

Nothing else in the library imports this package.
"""
