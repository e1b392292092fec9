"""Training-data operators: quality, mixing, tokens, dedup, packing, scans, sharding, language.

Nothing outside this subpackage imports it.
"""
