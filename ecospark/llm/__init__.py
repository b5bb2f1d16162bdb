"""Operators for large text corpora (quality, deduplication, secrets, mixing, tokenisation, sharding, search).

Nothing outside this package imports it; ``llm/queries.py`` registers one query per operator.
"""
