"""Corpus operators: quality rules, near-duplicate removal, mixing, sharding, token files, WARC.

Every operator is a function over DataFrames with its own parameters and real
outputs; ``queries`` holds the thin registered queries over the driver tables.
Nothing outside this subpackage imports it.
"""
