"""Structured Streaming versions of the upsert, counts and decay."""
