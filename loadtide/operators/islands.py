"""Gaps, contiguous segments and runs in an ordered series.

Gaps and segments take raw rows, however crowded. Runs and steps order the rows inside pieces of time that
are cut by counted rows (see `cuts`), so they take crowded rows too, if few share an instant. Null keys are a key of their own. Rows without a time are in no
segment, run or step; operators that return all rows give them a null segment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeaxis import DAY, floor_div, micros
from .cuts import ROWS, cuts
from .order import select_ranks
from .select import join_on


def _gap_buckets(df: DataFrame, time: str, gap: int, keys: Sequence[str]) -> DataFrame:
    """One row per key and non-empty bucket of width `gap`, with its segment number.

    Two rows of one bucket are closer than `gap`, so a segment can only break between
    buckets: the rows shrink to buckets in the map tasks before any ordering is done.
    """
    buckets = (df.filter(F.col(time).isNotNull()).select(*keys, micros(time).alias("__us"))
               .groupBy(*keys, floor_div(F.col("__us"), gap).alias("__bucket"))
               .agg(F.min("__us").alias("__from"), F.max("__us").alias("__to"), F.count(F.lit(1)).alias("__n")))
    order = Window.partitionBy(*keys).orderBy("__bucket")
    broken = (F.col("__from") - F.lag("__to").over(order) > gap).cast("int")
    marked = buckets.withColumn("__break", F.coalesce(broken, F.lit(0)))
    return marked.withColumn("segment_id", F.sum("__break").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def segment_islands(df: DataFrame, time: str, gap: int, keys: Sequence[str] = ()) -> DataFrame:
    """Segments between gaps longer than `gap` microseconds: start, end, row count."""
    return (_gap_buckets(df, time, gap, keys).groupBy(*keys, "segment_id")
            .agg(F.min("__from").alias("s"), F.max("__to").alias("e"), F.sum("__n").alias("n"))
            .select(*keys, "segment_id", F.timestamp_micros("s").alias("segment_start"),
                    F.timestamp_micros("e").alias("segment_end"), "n"))


def label_segments(df: DataFrame, time: str, gap: int, keys: Sequence[str] = ()) -> DataFrame:
    """Every row with the number of its segment."""
    labels = _gap_buckets(df, time, gap, keys).select(*keys, "__bucket", "segment_id")
    return join_on(df.withColumn("__bucket", floor_div(micros(time), gap)), labels, [*keys, "__bucket"], "left").select(
        *df.columns, "segment_id")


def gap_split(df: DataFrame, time: str, value: str, gap: int, keys: Sequence[str] = ()) -> DataFrame:
    """Flag the first row after a gap longer than `gap` and null its value, to break a line there."""
    firsts = (_gap_buckets(df, time, gap, keys).filter("__break = 1")
              .select(*keys, "__bucket", F.col("__from").alias("__first")))
    after_gap = F.coalesce(F.col("__first") == micros(time), F.lit(False))
    return (join_on(df.withColumn("__bucket", floor_div(micros(time), gap)), firsts, [*keys, "__bucket"], "left")
            .withColumn("after_gap", after_gap)
            .withColumn(value, F.when(~F.col("after_gap"), F.col(value)))
            .select(*df.columns, "after_gap"))


def flag_runs(df: DataFrame, time: str, flag: str, keys: Sequence[str] = (), chunk: int = 28 * DAY, rows: int | None = ROWS,
              cadence: int | None = None) -> DataFrame:
    """Maximal runs of equal `flag` in time order: start, end, row count.

    Runs are found inside each piece of time, then the ones that touch a border are
    joined up through a table with one row per piece.
    """
    work = df.filter(F.col(time).isNotNull()).select(*keys, micros(time).alias("__us"), F.coalesce(F.col(flag), F.lit(False)).alias(flag))
    work = cuts(df, time, keys, chunk, rows, cadence=cadence).place(work, F.col("__us"), "__chunk")
    inside = Window.partitionBy(*keys, "__chunk").orderBy("__us")
    change = (F.lag(flag).over(inside) != F.col(flag)).cast("int")
    marked = work.withColumn("__change", F.coalesce(change, F.lit(0)))
    local = (marked.withColumn("__run", F.sum("__change").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*keys, "__chunk", "__run", flag)
             .agg(F.min("__us").alias("__from"), F.max("__us").alias("__to"), F.count(F.lit(1)).alias("__n")))

    heads = local.groupBy(*keys, "__chunk").agg(
        F.min_by(flag, "__run").alias("__head"), F.max_by(flag, "__run").alias("__tail"),
        F.max("__from").alias("__tail_from"), F.max("__run").alias("__runs"))
    over_chunks = Window.partitionBy(*keys).orderBy("__chunk")
    joins_prev = F.coalesce(F.lag("__tail").over(over_chunks) == F.col("__head"), F.lit(False))
    heads = heads.withColumn("__joins", joins_prev)
    opened = F.when(~(F.col("__joins") & (F.col("__runs") == 0)), F.col("__tail_from"))
    heads = heads.withColumn("__open", F.last(opened, True).over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)))

    stitched = join_on(local, heads.select(*keys, "__chunk", "__joins", "__open"), [*keys, "__chunk"])
    start = F.when((F.col("__run") == 0) & F.col("__joins"), F.col("__open")).otherwise(F.col("__from"))
    return (stitched.withColumn("__start", start).groupBy(*keys, flag, "__start")
            .agg(F.max("__to").alias("__end"), F.sum("__n").alias("n"))
            .select(*keys, flag, F.timestamp_micros("__start").alias("run_start"),
                    F.timestamp_micros("__end").alias("run_end"), "n"))


def steps(df: DataFrame, time: str, keys: Sequence[str] = (), chunk: int = 28 * DAY, rows: int | None = ROWS,
          cadence: int | None = None) -> DataFrame:
    """Microseconds between each row and the one before it (the first row of a key has none)."""
    work = df.filter(F.col(time).isNotNull()).select(*keys, micros(time).alias("__us"))
    work = cuts(df, time, keys, chunk, rows, cadence=cadence).place(work, F.col("__us"), "__chunk")
    ends = work.groupBy(*keys, "__chunk").agg(F.max("__us").alias("__to"))
    over_chunks = Window.partitionBy(*keys).orderBy("__chunk")
    ends = ends.select(*keys, "__chunk", F.lag("__to").over(over_chunks).alias("__before"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy("__us")
    step = F.col("__us") - F.coalesce(F.lag("__us").over(inside), F.col("__before"))
    return (join_on(work, ends, [*keys, "__chunk"]).select(*keys, step.alias("step_us")).filter("step_us is not null"))


def median_step(df: DataFrame, time: str, keys: Sequence[str] = (), chunk: int = 28 * DAY, rows: int | None = ROWS,
                cadence: int | None = None) -> DataFrame:
    """Median time between neighbouring rows, in seconds, exact at any size."""
    gaps = steps(df, time, keys, chunk, rows, cadence)
    low, high = select_ranks(gaps, F.col("step_us"), [lambda n: F.floor((n - 1) / 2), lambda n: F.floor(n / 2)])
    middle = None if low is None else (low + high) / 2 / 1_000_000
    return df.sparkSession.range(1).select(F.lit(middle).cast("double").alias("median_step_s"))
