"""Operators for preparing training corpora: filters, deduplication, sharding, scoring, output.

Nothing else in the package imports this one.
"""
