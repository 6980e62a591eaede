"""Operators for training-data corpora: packing, secret scans, search, near-duplicates, quality, sharding.

Nothing else in the library imports this subpackage. ``catalog`` names one query per operator.
"""
