"""Operators for large text corpora: filters, near-duplicates, repeats, scans, mixing, scores."""
