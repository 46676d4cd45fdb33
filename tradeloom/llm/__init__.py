"""Operators for training data: scoring, counting, archives, deduplication, tokens."""
