"""Operators for training data: deduplication, search, classification, tokens, mixing."""
