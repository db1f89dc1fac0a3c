"""Operators of a training-data pipeline: scoring, tokenizing, near-duplicates, archives, filters, mixing."""
