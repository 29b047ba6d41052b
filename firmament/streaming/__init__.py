"""Structured Streaming variants of the frontier fold and the card upsert."""
