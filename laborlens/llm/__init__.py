"""Operators for building training corpora: cleaning, deduplication, tokens, packing, search and scoring."""
