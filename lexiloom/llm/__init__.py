"""Operators for training data: language, deduplication, encoding repair, page bodies, tokens, mixing, abuse.

Nothing outside this package imports it; the rest of the library works without it.
"""
