"""Operators for training data: scoring, fingerprints, privacy, secrets, quality, pages, records, near copies, mixing, pieces."""
