"""Operators for preparing training data: text, web archives, vectors and sequences.

Nothing else in the library imports this package.
"""
