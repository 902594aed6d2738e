"""Compositions of operators: raw to clean, clean to roll-ups, clean to models."""
