"""Operators for preparing training data: extraction, filters, dedup, packing, formatting."""
