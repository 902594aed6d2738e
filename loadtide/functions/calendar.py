"""Calendar and cyclic columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import FIXED_HOLIDAYS
from .timeaxis import col


def calendar_parts(time: str | Column) -> dict[str, Column]:
    t = col(time)
    return {
        "hour": F.hour(t),
        "day_of_week": F.dayofweek(t),
        "day_of_year": F.dayofyear(t),
        "week_of_year": F.weekofyear(t),
        "month": F.month(t),
        "year": F.year(t),
        "quarter": F.quarter(t),
    }


def is_weekend(time: str | Column) -> Column:
    return F.dayofweek(col(time)).isin(1, 7)


def is_peak_hour(time: str | Column, first: int = 8, last: int = 20) -> Column:
    """Working-day hours, both ends included."""
    return F.hour(col(time)).between(first, last) & ~is_weekend(time)


def season(time: str | Column) -> Column:
    """0 winter (Dec-Feb), 1 spring, 2 summer, 3 autumn."""
    return F.floor((F.month(col(time)) % 12) / 3).cast("int")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_fixed_holiday(day: str | Column) -> Column:
    md = F.month(col(day)) * 100 + F.dayofmonth(col(day))
    return md.isin([m * 100 + d for m, d in FIXED_HOLIDAYS])


def holiday_weekend_flag(day: str | Column) -> Column:
    return is_weekend(day) | is_fixed_holiday(day)


def month_label(time: str | Column) -> Column:
    return F.date_format(col(time), "yyyy-MM")


def hours_in_month(time: str | Column) -> Column:
    return F.dayofmonth(F.last_day(col(time))) * 24


def fmt_range(low: Column, high: Column, sep: str = " → ") -> Column:
    return F.concat_ws(sep, F.date_format(low, "yyyy-MM-dd"), F.date_format(high, "yyyy-MM-dd"))
