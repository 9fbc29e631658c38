"""Operators for preparing training data: sharding, mixing, extraction, filtering, deduplication, packing, search.

Every operator is a module of its own; `queries` registers them. Nothing outside this package imports it.
"""
