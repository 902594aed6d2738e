"""Structured Streaming jobs: produce, land, de-duplicate, roll up, upsert."""
