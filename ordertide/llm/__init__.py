"""Operators for preparing training data: filters, deduplication, scoring, formatting and packing."""
