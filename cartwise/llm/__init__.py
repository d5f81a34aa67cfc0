"""Operators of a training-data pipeline: near-dedup, language ID, tokens, shards, packing, PII.

Nothing else in the library imports this subpackage. The operators take and return DataFrames;
``queries`` holds the named queries over the test tables.
"""
