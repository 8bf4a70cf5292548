"""Operators for preparing training data: mixing, quality, language, duplicates, tokens, packing, sharding."""
