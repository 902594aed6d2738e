"""Flagging and filling missing values of an ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeaxis import DAY, micros
from .cuts import ROWS, cuts


def flag_missing(df: DataFrame, columns: Sequence[str], suffix: str = "_was_null") -> DataFrame:
    return df.select("*", *[F.col(c).isNull().alias(c + suffix) for c in columns])


def fill_gaps(df: DataFrame, time: str, columns: Sequence[str], keys: Sequence[str] = (),
              period: Column | None = None, chunk: int = 32 * DAY, rows: int | None = ROWS, cadence: int | None = None) -> DataFrame:
    """Own value, else the last one before, else the first one after, inside each key and period.

    The series is cut into pieces of time with about `rows` rows at most (see `cuts`). Each piece is filled by itself; what it needs
    from outside (last value before it, first value of the period) comes from a table with one row per piece. Both are made of
    the same shuffled rows, so the input is scanned once, besides the count of rows by time. So a long series spreads over
    many tasks, however its rows crowd. Null keys are a key of their own; rows without a time stay as they are.
    """
    where = cuts(df, time, keys, chunk, rows, cadence=cadence)
    group = F.struct(*keys, (F.lit(0) if period is None else period).alias("__period"))  # a struct with nulls equals its like
    work = where.place(df.withColumn("__us", micros(time)), F.col("__us"), "__chunk").withColumn("__group", group).repartition("__group", "__chunk")

    def when_set(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col("__us"))

    # `__row` is a row of the piece and its test is always true: with it the table of pieces needs every column, as the rows do,
    # so that one exchange serves both.
    ends = work.groupBy("__group", "__chunk").agg(
        *[F.max_by(c, when_set(c)).alias(f"__last_{c}") for c in columns],
        *[F.min_by(c, when_set(c)).alias(f"__first_{c}") for c in columns],
        F.any_value(F.struct(*df.columns)).alias("__row")).filter(F.pmod(F.hash("__row"), F.lit(2)) < 2).drop("__row")
    over_chunks = Window.partitionBy("__group").orderBy("__chunk")
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
    whole = over_chunks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(
        "__group", "__chunk",
        *[F.last(f"__last_{c}", True).over(before).alias(f"__prev_{c}") for c in columns],
        *[F.first(f"__first_{c}", True).over(whole).alias(f"__next_{c}") for c in columns])

    # A row with nothing before it takes the first value of its whole period, so no frame looks
    # forward (Spark walks such a frame to its end again for every row).
    inside = Window.partitionBy("__group", "__chunk").orderBy("__us")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = work.join(carried, ["__group", "__chunk"], "left")
    filled = {
        c: F.coalesce(c, F.when(F.col("__us").isNotNull(), F.coalesce(F.last(c, True).over(upto), F.col(f"__prev_{c}"), F.col(f"__next_{c}"))))
        for c in columns
    }
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
