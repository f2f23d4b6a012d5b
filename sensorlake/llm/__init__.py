"""Operators for large text corpora: deduplication, filtering, formatting, scoring and packing of training documents."""
