"""Operators for preparing training data: extraction, cleaning, dedup, mixing, sharding."""
