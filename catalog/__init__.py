"""Registered queries: each runs a library operator over the given tables.

Where SQL can say the same thing, the query carries that SQL too.
"""

from . import audit, calendars, compare, ingest, models, publish, quality, rollups, series, streams  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
