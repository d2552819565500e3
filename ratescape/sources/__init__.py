"""Readers and writers for rate files, indexes, registries and rate tables."""
