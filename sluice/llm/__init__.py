"""Operators for preparing training text: sharding, dedup, filters, tokens, scoring."""
