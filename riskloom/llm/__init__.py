"""Operators of a training-data pipeline: deduplication, tokens, filters, archives, search."""
