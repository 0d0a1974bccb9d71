"""Operators of a training-data pipeline: scoring, formatting, tokens, dedup, packing."""
