"""Operators for preparing training text: counting, encoding, filtering, mixing, joining and scoring documents.

Nothing else in the library imports this subpackage.
"""
