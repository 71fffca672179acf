"""Operators for preparing training data: scoring, cleaning, deduplicating, encoding and packing texts."""
