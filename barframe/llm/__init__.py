"""Operators for preparing text corpora: scans, deduplication, search, extraction, mixing."""
