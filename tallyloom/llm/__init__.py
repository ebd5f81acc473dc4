"""Operators for preparing training text: deduplication, counting, packing, mixing, filtering, extraction, search.

Each module holds one operator with its own general interface; ``queries`` holds
the thin registered queries and their DuckDB statements. Nothing else in the
library imports this package.
"""
