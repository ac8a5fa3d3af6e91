"""Operators for building training data: cleaning, deduplication, sharding and encoding of text."""
