"""Loads all modules that register queries."""

from . import chat_format, html_main, line_rules, lm_scoring, mixing, near_dedup, pieces, pii, records, secrets, source_audit, syncmers, whitening  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
