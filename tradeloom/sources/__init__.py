"""Readers of landed data and writers of keyed tables."""
