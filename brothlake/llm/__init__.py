"""Operators for building training corpora: token counts, encoding, filters, deduplication, mixing, search and archives."""
