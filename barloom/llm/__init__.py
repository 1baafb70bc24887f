"""Operators for training-data corpora: filtering, deduplication, encoding, packing."""
