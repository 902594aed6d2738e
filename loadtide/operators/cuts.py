"""Pieces of a series along time, narrow where rows crowd.

Operators work on pieces of a series so that no task holds one key's rows. A piece is a slot of time; where a slot holds more than `rows`
rows, it is cut into 64, and so on down to a least width. Rows are counted per key and slot in the map tasks; only crowded slots are counted
again, and only they are named in a table, which rows are joined to. A series without crowded slots costs one count and no join, and one
whose `cadence` is known (at least so long between the rows of a key, as after `rollup.resample`) not even the count, if a slot of
`chunk` can't hold more than `rows` rows then. A cadence that isn't true costs balance, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeaxis import micros
from ..sources.scratch import materialize
from .select import join_on

ROWS = 1 << 17
STEP = 64


def nested(chunk: int, least: int = 1) -> list[int]:
    """Widths from about `chunk` down to `least`, each a whole multiple of the next."""
    out = [least]
    while out[-1] < chunk:
        out.append(out[-1] * min(STEP, -(-chunk // out[-1])))
    return out[::-1]


def _start(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width).cast("long"))


@dataclass(frozen=True)
class Cuts:
    """`crowded[k]` names the slots of `widths[k]` that are cut further; `full`: some of the least width still hold more."""

    keys: tuple[str, ...]
    widths: tuple[int, ...]
    crowded: tuple[DataFrame, ...]
    full: bool

    def place(self, df: DataFrame, us: Column, name: str) -> DataFrame:
        """`df` with the start of the piece that the time `us` (microseconds) lies in."""
        width = F.lit(self.widths[0]).cast("long")
        for k, slots in enumerate(self.crowded):
            flagged = slots.withColumn(f"__deep_{k}", F.lit(True))
            df = join_on(df.withColumn("__slot", _start(us, self.widths[k])), flagged, [*self.keys, "__slot"], "left").drop("__slot")
            width = F.when(F.col(f"__deep_{k}"), F.lit(self.widths[k + 1]).cast("long")).otherwise(width)
        return df.withColumn(name, us - F.pmod(us, width)).drop(*[f"__deep_{k}" for k in range(len(self.crowded))])


def cuts(df: DataFrame, time: str | Column, keys: Sequence[str], chunk: int, rows: int | None = ROWS, least: int = 1,
         cadence: int | None = None) -> Cuts:
    """Where to cut; reads times and keys once, and crowded slots again. With `rows` None all pieces have the width `chunk`."""
    widths = nested(chunk, least)
    if rows and cadence and widths[0] <= cadence * rows:
        rows = None
    crowded: list[DataFrame] = []
    left = df.select(*keys, micros(time).alias("__us")).filter("__us is not null")
    while rows is not None:
        slot = _start(F.col("__us"), widths[len(crowded)]).alias("__slot")
        over = left.groupBy(*keys, slot).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > rows).drop("__n")
        if over.isEmpty():
            break
        if len(crowded) == len(widths) - 1:
            return Cuts(tuple(keys), tuple(widths), tuple(crowded), True)
        crowded.append(materialize(over))
        left = join_on(left.withColumn("__slot", slot), crowded[-1], [*keys, "__slot"], "left_semi").drop("__slot")
    return Cuts(tuple(keys), tuple(widths), tuple(crowded), False)
