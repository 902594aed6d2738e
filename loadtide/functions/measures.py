"""Numeric column expressions: means, shares, errors, flags, warehouse types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeaxis import col


def mean_of(c: str | Column) -> Column:
    """Mean as total over count: exact when the input is a decimal, whatever the row order."""
    c = col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def as_double(c: str | Column) -> Column:
    return col(c).try_cast("double")


def share_pct(parts: Iterable[str | Column], total: str | Column) -> Column:
    """Sum of the parts (null counts as 0) in percent of a positive total, else null."""
    whole = col(total)
    added = sum((F.coalesce(col(p), F.lit(0.0)) for p in parts), F.lit(0.0))
    return F.when(whole > 0, added / whole * 100)


def plain_share_pct(part: str | Column, total: str | Column) -> Column:
    """Share of one part; a missing part gives null."""
    return F.when(col(total) > 0, col(part) / col(total) * 100)


def forecast_error(actual: str | Column, forecast: str | Column) -> Column:
    return col(actual) - col(forecast)


def forecast_error_pct(actual: str | Column, forecast: str | Column) -> Column:
    return F.when(col(actual) > 0, F.abs(forecast_error(actual, forecast)) / col(actual) * 100)


def completeness(columns: Iterable[str | Column]) -> Column:
    """Share of the listed columns that hold a value, 0 to 1."""
    flags = [col(c).isNotNull().cast("int") for c in columns]
    return sum(flags[1:], flags[0]) / F.lit(len(flags))


def is_outlier(value: str | Column, low: float, high: float) -> Column:
    v = col(value)
    return v.isNull() | (v < 0) | (v < low) | (v > high)


def within_or_null(value: str | Column, low: float, high: float) -> Column:
    return col(value).isNull() | col(value).between(low, high)


def all_present(columns: Iterable[str | Column]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & col(c).isNotNull()
    return cond


def energy_gwh(total_mw: Column, cadence_hours: float = 0.5) -> Column:
    """A total of power readings as energy: one reading stands for `cadence_hours`."""
    return total_mw.cast("double") * F.lit(cadence_hours) / 1000


def label_map(code: str | Column, labels: Mapping[str, str], fallback: Column | None = None) -> Column:
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(code)),
                      fallback if fallback is not None else col(code))


def warehouse_cast(c: str | Column, kind) -> Column:
    """Rounding cast into NUMERIC(p, s) or a named type; a value that does not fit becomes null."""
    if isinstance(kind, tuple):
        precision, scale = kind
        # First to 12 decimals: 0.125 off by the last bit of a double still rounds up, as in a warehouse.
        return F.round(col(c).try_cast("decimal(38,12)"), scale).try_cast(f"decimal({precision},{scale})")
    if kind in ("smallint", "int"):
        return F.round(col(c)).try_cast(kind)
    return col(c).try_cast(kind)


def overflow(c: str | Column, kind) -> Column:
    return col(c).isNotNull() & warehouse_cast(c, kind).isNull()
