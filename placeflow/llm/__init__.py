"""Operators for training data: quality, duplicates, contamination, personal data, tokens."""
