"""Operators for preparing training text: deduplication, filtering, search, scoring and packing."""
