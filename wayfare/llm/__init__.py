"""Operators for building training corpora: tokens, packing, deduplication, filters, fingerprints."""
