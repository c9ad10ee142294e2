"""Operators of a training-data pipeline: sampling, scoring, search, deduplication, sharding.

Nothing outside this package imports it.  ``tessera.llm.queries`` registers the thin queries.
"""
