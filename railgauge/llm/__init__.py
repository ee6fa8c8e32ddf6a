"""Operators for training data: deduplication, packing, filters, fingerprints and token counts.

Nothing else in the library imports this package.
"""
