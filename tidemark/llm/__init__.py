"""Operators for preparing training text: sharding, deduplication, tokens, mixing, search.

Every operator takes and returns a ``DataFrame``; registered queries are in ``queries``.
"""
