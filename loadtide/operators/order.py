"""Order statistics, time prefixes and stride samples without a global sort."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeaxis import DAY, SECOND, floor_div, micros
from .lookback import with_row_index

_BITS = 20


def select_ranks(df: DataFrame, value: Column, ranks: Sequence[Callable[[Column], Column]]) -> list[int | None]:
    """The values at the given 0-based ranks (functions of the row count) of whole numbers.

    Radix selection in three counting jobs over 20-bit digits. Each job aggregates in the map
    tasks to a bounded number of counts per rank, however many rows there are and however many are
    equal, and hands the driver one row per rank. Nulls do not count; no rows give None. The
    input is read three times: hand in a written or materialised frame where it is dear.
    """
    rows = df.select(value.cast("long").alias("v")).filter("v is not null")
    found = [0] * len(ranks)
    left: list[Column] = []
    for shift in (2 * _BITS, _BITS, 0):
        first = shift == 2 * _BITS
        prefix = F.lit(0).cast("long") if first else F.shiftright("v", shift + _BITS)
        digit = F.shiftright("v", shift) if first else F.pmod(F.shiftright("v", shift), F.lit(1 << _BITS).cast("long"))
        within = rows if first else rows.filter(prefix.isin(sorted(set(found))))
        counts = within.groupBy(prefix.alias("prefix"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        side = Window.partitionBy("prefix")
        running = counts.select("*", (F.sum("n").over(side.orderBy("digit")) - F.col("n")).alias("below"),
                                F.sum("n").over(side).alias("total"))
        if first:
            left = [r(F.col("total")).cast("long") for r in ranks]
        inside = [(F.col("prefix") == p) & (F.col("below") <= r) & (r < F.col("below") + F.col("n"))
                  for p, r in zip(found, left)]
        hits = running.filter(reduce(lambda a, b: a | b, inside)).select(
            "digit", *[F.when(i, r - F.col("below")).alias(f"r{k}") for k, (i, r) in enumerate(zip(inside, left))]).collect()
        if not hits:
            return [None] * len(ranks)
        for k in range(len(ranks)):
            hit = next(h for h in hits if h[f"r{k}"] is not None)
            found[k] = (found[k] << _BITS) | hit.digit
            left[k] = F.lit(hit[f"r{k}"])
    return list(found)


def prefix_cutoff(df: DataFrame, time: str, size: Callable[[Column], Column]) -> Column:
    """Time of the `size(n)`-th row in time order, as a constant the scan can filter by."""
    nth = select_ranks(df, micros(time), [lambda n: F.greatest(size(n).cast("long"), F.lit(1)) - 1])[0]
    return F.timestamp_micros(F.lit(nth).cast("long"))


def time_prefix(df: DataFrame, time: str, size: Callable[[Column], Column]) -> DataFrame:
    """Rows up to that cutoff; rows that share the cutoff time all stay."""
    return df.filter(F.col(time) <= prefix_cutoff(df, time, size))


def time_split(df: DataFrame, time: str, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training rows up to the cutoff of the first `ratio` of the rows, test rows after it."""
    cutoff = prefix_cutoff(df, time, lambda n: F.floor(n * F.lit(ratio)))
    return df.filter(F.col(time) <= cutoff), df.filter(F.col(time) > cutoff)


def every_nth(df: DataFrame, time: str, max_points: int | None = None, step: int | None = None,
              chunk: int = SECOND, block: int = DAY, tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """Every n-th row in time order: a given `step`, or the one that leaves about `max_points` rows.

    Rows without a time have no place in the order; they are left out, but for step 1, which keeps every row.
    Give a `tie_break` where times repeat.
    """
    if step == 1:
        return df
    df = df.filter(F.col(time).isNotNull())
    indexed = with_row_index(df, [time, *tie_break], (), floor_div(micros(time), chunk), "__pos", block // chunk)
    if step is None:
        n = df.agg(F.count(F.lit(1))).scalar()
        stride = F.greatest(F.floor(n / max_points), F.lit(1)).cast("long")
    else:
        stride = F.lit(step).cast("long")
    return indexed.filter(F.col("__pos") % stride == 0).select(*df.columns)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)
