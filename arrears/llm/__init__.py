"""Operators for preparing text corpora: cleaning, deduplication, mixing, tokens, search."""
