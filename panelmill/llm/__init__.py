"""Operators of a training-data pipeline: quality, archives, duplicates, tokens, packing, search."""
