"""Operators for large text corpora: filters, near-duplicate joins, tokenisation, extraction.

Nothing outside this subpackage imports it.
"""
