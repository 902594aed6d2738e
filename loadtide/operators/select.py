"""Projections and filters with tolerant columns and data-relative bounds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import as_double, within_or_null


def available(df: DataFrame, columns: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def available_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*available(df, columns))


def cast_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Listed columns that exist become double in one projection; bad text becomes null."""
    wanted = set(available(df, columns))
    return df.select(*[as_double(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c).isNotNull())
    return df


def range_filter_nullable(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    for c, (low, high) in bounds.items():
        df = df.filter(within_or_null(c, low, high))
    return df


def trailing_window(df: DataFrame, time: str, days: int) -> DataFrame:
    """Rows within `days` of the newest time in the table itself.

    The newest time is a scalar subquery: it runs once and becomes a constant that the
    Parquet scan can use.
    """
    newest = df.agg(F.max(time)).scalar()
    return df.filter(F.col(time) >= newest - F.make_dt_interval(F.lit(days)))


def recent_view(df: DataFrame, time: str, as_of: datetime | Column, days: int,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the last `days` before `as_of`, newest first."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    out = df.filter(F.col(time) >= now - F.make_dt_interval(F.lit(days))).orderBy(F.col(time).desc())
    return available_columns(out, columns) if columns else out


def window_to_bounds(df: DataFrame, reference: DataFrame, time: str, reference_time: str | None = None) -> DataFrame:
    """Rows of `df` between the first and last time of `reference`."""
    rt = reference_time or time
    low = reference.agg(F.min(rt)).scalar()
    high = reference.agg(F.max(rt)).scalar()
    return df.filter(F.col(time).between(low, high))


def cross_bounds(df: DataFrame, time: str) -> DataFrame:
    """Every row with the table's first and last time beside it (scalar subqueries, no join)."""
    return df.select("*", df.agg(F.min(time)).scalar().alias("min_time"),
                     df.agg(F.max(time)).scalar().alias("max_time"))


def table_bounds(tables: Mapping[str, DataFrame], time: str) -> DataFrame:
    """Row count, first and last time of each named table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))
        row = row.select(F.lit(name).alias("table_name"), "n", "min_time", "max_time")
        out = row if out is None else out.unionAll(row)
    return out


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on key columns in which null equals null; the keys appear once, as in the left frame."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(renamed[f"__r_{k}"])
    joined = left.join(renamed, same, how) if keys else left.join(renamed, how=how)
    return joined.drop(*[f"__r_{k}" for k in keys])
