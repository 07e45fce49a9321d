"""Operators for training data: scoring, cleaning, deduplication, tokenizing and archives of text."""
