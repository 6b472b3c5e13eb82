"""Operators for training-data pipelines: deduplication, search, scans, mixing, tokenizing.

Nothing else in the library imports this subpackage.
"""
