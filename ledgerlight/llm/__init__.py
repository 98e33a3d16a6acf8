"""Operators of a text pipeline: scoring, deduplication, search, tokens, language model, packing, personal data."""
