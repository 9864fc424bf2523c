"""Operators for preparing training data: quality, language, duplicates, tokens, packing and search."""
