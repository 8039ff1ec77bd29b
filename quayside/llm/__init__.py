"""Operators of a training-data pipeline: quality, deduplication, language, archives, tokens, packing, personal data."""
