"""Operators for training-data pipelines (dedup, mixing, sharding, scoring, extraction).

Each module holds one operator with its own general interface; ``queries`` binds
them to the provided tables. Nothing outside this package imports it.
"""
