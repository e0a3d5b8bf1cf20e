"""Operators for large text corpora: tokens, quality, extraction, duplicates, leaks, packing."""
