"""Expressions on the time axis, in whole microseconds so that they are exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 3_600 * SECOND
DAY = 24 * HOUR


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(time: str | Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(col(time).cast("timestamp"))


def floor_div(x: Column, width: int) -> Column:
    """Whole-number floor division, right below zero too."""
    w = F.lit(width).cast("long")
    return F.call_function("div", x - F.pmod(x, w), w)


def slot_start(time: str | Column, width: int) -> Column:
    """Start of the fixed-width slot a time falls in."""
    us = micros(time)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width).cast("long")))


def ago(time: Column, width: int) -> Column:
    return F.timestamp_micros(micros(time) - F.lit(width).cast("long"))
