"""Training-data pipeline operators: scoring, search, records, cleaning, tokens, packing and deduplication.

Nothing outside this subpackage imports it.
"""
