"""Operators of a training-data pipeline: filtering, duplicate search, tokens, formatting and packing of texts."""
