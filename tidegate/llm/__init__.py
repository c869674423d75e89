"""Operators for training text: scoring, filtering, deduplication, extraction and packing."""
