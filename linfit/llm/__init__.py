"""Operators for preparing training data: mixing, deduplication, search, filters, tokens."""
