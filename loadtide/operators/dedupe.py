"""One row per key, with a stated winner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeaxis import micros, slot_start


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key that comes first in `order` (ascending, nulls first; negate to turn round).

    `row_number() = 1` makes Spark put a group limit before the shuffle as well: every map
    task sends one row per key at most, so a key that holds much of the table stays harmless.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", first).filter("__rank = 1").drop("__rank")


def keep_last_in_slot(df: DataFrame, time: str, width: int, keys: Sequence[str] = (),
                      tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """Floor the time to `width` microseconds and keep the newest row of each slot.

    Ties on the time go to the first row in `tie_break`; `time` becomes the slot start.
    """
    slotted = df.withColumn("__us", micros(time)).withColumn(time, slot_start(time, width))
    return keep_first(slotted, [*keys, time], [-F.col("__us"), *tie_break]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows; two-level count, so no single task sees the raw keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicated_keys"),
    )
