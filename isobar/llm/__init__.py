"""Operators for preparing training text: counting, deduplication, filtering, packing, search."""
