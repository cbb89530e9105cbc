"""Operators of a training-data pipeline: deduplication, filters, fingerprints, search, tokens, packing, shards."""
