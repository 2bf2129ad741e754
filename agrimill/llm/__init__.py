"""Operators for large text corpora: cleaning, deduplication, mixing, packing, storage and search."""
