"""Expressions that turn text cells into typed values; bad cells become null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import NULL_CELLS
from .timeaxis import col


def parse_text(cell: str | Column, nulls: Iterable[str] = NULL_CELLS) -> Column:
    c = F.trim(col(cell))
    return F.when(~c.isin(list(nulls)), c)


def parse_number(cell: str | Column, nulls: Iterable[str] = NULL_CELLS) -> Column:
    """Decimal comma allowed."""
    return F.replace(parse_text(cell, nulls), F.lit(","), F.lit(".")).try_cast("double")


def event_time(date: str | Column, time: str | Column, source_tz: str = "UTC") -> Column:
    """Instant from `yyyy-MM-dd` and `HH:mm` text given in `source_tz`; no time means midnight.

    The text is read at a fixed offset, so the session's zone plays no part. A local time that
    occurs twice (end of summer time) is taken as the first of the two.
    """
    clock = F.coalesce(F.nullif(F.trim(col(time)), F.lit("")), F.lit("00:00"))
    text = F.concat_ws(" ", col(date), clock, F.lit("+00:00"))
    wall = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm XXX"))
    return wall if source_tz == "UTC" else F.to_utc_timestamp(wall, source_tz)


def parse_instant(text: str | Column) -> Column:
    """Instant from ISO text with or without an offset, or any text Spark can read."""
    t = col(text)
    return F.coalesce(
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(t),
    )


def json_detail(columns: Iterable[str | Column]) -> Column:
    return F.to_json(F.struct(*[col(c) for c in columns]))


def detail_text(detail: str | Column, key: str, limit: int = 120) -> Column:
    """A key of a JSON text, or the start of a text that is not JSON."""
    d = col(detail)
    return F.coalesce(F.when(d.startswith("{"), F.get_json_object(d, f"$.{key}")),
                      F.substring(F.coalesce(d, F.lit("")), 1, limit))
