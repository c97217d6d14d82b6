"""Operators that prepare training text: filters, deduplication, scans, mixing and packing."""
