"""Operators of a training-data pipeline (deduplication, mixing, tokens, search, ...).

Nothing else in the library imports this subpackage.
"""
