"""Lags and rolling statistics over a long ordered series, without one task per series.

Both forms cut the series into pieces and copy the rows a piece needs from its predecessor
into it. Input: one row per key and time (see `dedupe`). Null keys are a key of their own; rows without
a time keep their place in the result, with null features, and count for no other row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeaxis import DAY, floor_div, micros
from .cuts import ROWS, cuts
from .running import Frame, with_frames
from .select import join_on


@dataclass(frozen=True)
class Lag:
    """Value `back` earlier: microseconds for time lags, rows for row lags."""

    column: str
    back: int


@dataclass(frozen=True)
class Rolling:
    """Statistic over the `back` before the current row.

    Time form: the open-closed frame (t - back, t]. Row form: `back` rows and the current one.
    """

    column: str
    back: int
    stat: str = "mean"  # mean | std | sum | min | max | count
    min_count: int = 1
    include_current: bool = True


def _frames(features: Mapping[str, Lag | Rolling], more: int) -> dict[str, Frame]:
    """The rolling features; a row frame covers `more` = 1 rows than it looks back."""
    return {n: Frame(f.column, f.back + more, f.stat, f.include_current, f.min_count) for n, f in features.items() if isinstance(f, Rolling)}


def time_windows(df: DataFrame, time: str, features: Mapping[str, Lag | Rolling],
                 keys: Sequence[str] = (), chunk: int = 28 * DAY, rows: int | None = ROWS, cadence: int | None = None) -> DataFrame:
    """Time-based features: a lag is the value at exactly that instant, null if there is none.

    One shuffle and one sort for all features. A (key, piece) group holds about `rows` rows and the look-back before them; pieces
    are cut by counted rows (see `cuts`), down to the longest look-back. Where still more rows crowd within one look-back, lags are fetched by an
    equi-join on the instant instead, which no crowd can skew; rolling statistics pass such a piece in order, in time and
    memory that don't grow with the frame.
    """
    reach = max(f.back for f in features.values())
    untimed, df = df.filter(F.col(time).isNull()), df.filter(F.col(time).isNotNull())
    where = cuts(df, time, keys, max(chunk, reach), rows, reach, cadence)
    if where.full and any(isinstance(f, Lag) for f in features.values()):
        rest = {n: f for n, f in features.items() if isinstance(f, Rolling)}
        found = _lags_at(df, time, {n: f for n, f in features.items() if isinstance(f, Lag)}, keys)
        timed = time_windows(found, time, rest, keys, chunk, rows) if rest else found
        return _with_untimed(timed.select(*df.columns, *features), untimed)
    pieces = where.place(df.withColumn("__us", micros(time)), F.col("__us"), "__own")
    if where.crowded:  # pieces are no shorter than the look-back: a row is in its own and at most one more
        pieces = where.place(pieces, F.col("__us") + F.lit(reach).cast("long"), "__then").select(
            "*", F.explode(F.array_distinct(F.array("__own", "__then"))).alias("__piece"))
    else:
        width = F.lit(where.widths[0]).cast("long")
        pieces = pieces.select("*", F.explode(F.sequence(F.col("__own"), F.col("__own") + floor_div(
            F.col("__us") - F.col("__own") + F.lit(reach).cast("long"), where.widths[0]) * width, width)).alias("__piece"))
    order = Window.partitionBy(*keys, "__piece").orderBy("__us")

    lags = [F.max(f.column).over(order.rangeBetween(-f.back, -f.back)).alias(n) for n, f in features.items() if isinstance(f, Lag)]
    rolled = with_frames(pieces.select("*", *lags), [*keys, "__piece"], "__us", _frames(features, 0))
    return _with_untimed(rolled.filter("__piece = __own").select(*df.columns, *features), untimed)


def _lags_at(df: DataFrame, time: str, lags: Mapping[str, Lag], keys: Sequence[str]) -> DataFrame:
    """`df` (rows with a time) with its lags, each row's values sent to the instants that look back on it."""
    kinds = {f.name: f.dataType for f in df.schema}
    sent = df.select(*keys, micros(time).alias("__us"), F.explode(F.array(*[
        F.struct(F.lit(f.back).cast("long").alias("back"), *[(F.col(f.column) if m == n else F.lit(None).cast(kinds[g.column])).alias(m)
                                                             for m, g in lags.items()])
        for n, f in lags.items()])).alias("__sent"))
    sent = sent.groupBy(*keys, (F.col("__us") + F.col("__sent.back")).alias("__us")).agg(*[F.max(f"__sent.{n}").alias(n) for n in lags])
    return join_on(df.withColumn("__us", micros(time)), sent, [*keys, "__us"], "left").select(*df.columns, *lags)


def _with_untimed(timed: DataFrame, untimed: DataFrame) -> DataFrame:
    """Rows without a time beside the others, their features null."""
    have = set(untimed.columns)
    return timed.unionByName(untimed.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                                              for f in timed.schema]))


def with_row_index(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str], chunk: Column,
                   name: str = "row_index", per_block: int | None = None) -> DataFrame:
    """Exact 0-based position of each row inside its key, in `order`.

    `chunk` is a whole number that never falls along `order` (such as the day). Rows are
    numbered inside each chunk; the chunk's offset is a running sum over one row per chunk.
    Where rows can crowd, take fine chunks (such as the second) and let `per_block` of them
    form a block: the running sum then goes over blocks first and over chunks inside a block.
    """
    work = df.withColumn("__chunk", chunk)
    sizes = work.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("__n"))

    def below(frame: DataFrame, group: Sequence[str], by: str, out: str) -> DataFrame:
        before = Window.partitionBy(*group).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(out, F.coalesce(F.sum("__n").over(before), F.lit(0)))

    if per_block is None:
        offsets = below(sizes, keys, "__chunk", "__offset").drop("__n")
    else:
        sizes = sizes.withColumn("__block", floor_div(F.col("__chunk"), per_block))
        blocks = sizes.groupBy(*keys, "__block").agg(F.sum("__n").alias("__n"))
        starts = below(blocks, keys, "__block", "__start").drop("__n")
        inner = below(sizes, [*keys, "__block"], "__chunk", "__inner").drop("__n")
        offsets = join_on(inner, starts, [*keys, "__block"]).select(
            *keys, "__chunk", (F.col("__start") + F.col("__inner")).alias("__offset"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    return (join_on(work, offsets, [*keys, "__chunk"])
            .withColumn(name, F.col("__offset") + F.row_number().over(inside) - 1)
            .drop("__chunk", "__offset"))


def row_windows(df: DataFrame, time: str, features: Mapping[str, Lag | Rolling],
                keys: Sequence[str] = (), period: Column | None = None,
                chunk: int = 28 * DAY, block: int = 8192, rows: int | None = ROWS, cadence: int | None = None) -> DataFrame:
    """Row-based features, restarting in each key and period (such as the year).

    Rows are numbered (inside pieces of time cut by counted rows, see `cuts`), cut into equal blocks, and the last rows of a block
    are copied into the next one; every window group has at most block + longest look-back rows.
    """
    reach = max(f.back for f in features.values())
    block = max(block, reach)
    columns = df.columns
    untimed, df = df.filter(F.col(time).isNull()), df.filter(F.col(time).isNotNull())
    work, group = df, list(keys)
    if period is not None:
        work, group = work.withColumn("__period", period), [*group, "__period"]
    cut = cuts(df, time, keys, chunk, rows, cadence=cadence).place(work, micros(time), "__cut")
    numbered = with_row_index(cut, [time], group, F.col("__cut"), "__pos")
    pos = F.col("__pos")
    pieces = numbered.select(
        "*", floor_div(pos, block).alias("__own"),
        F.explode(F.sequence(floor_div(pos, block), floor_div(pos + reach, block))).alias("__piece"))
    order = Window.partitionBy(*group, "__piece").orderBy("__pos")

    lags = [F.lag(f.column, f.back).over(order).alias(n) for n, f in features.items() if isinstance(f, Lag)]
    rolled = with_frames(pieces.select("*", *lags), [*group, "__piece"], "__pos", _frames(features, 1))
    return _with_untimed(rolled.filter("__piece = __own").select(*columns, *features), untimed)
