"""Statistics over a sliding frame whose cost for each row doesn't depend on the frame's length.

A frame (axis - width, axis] is never walked. Sums and counts are what had been seen up to the row less what had been seen up to the
frame's start: two running values, each moved on once for each row. Running sums of doubles would leave the rounding of everything
before the frame in it, so doubles are first put on one binary scale per group (as whole numbers of 61 bits, relative to the group's largest
value), which makes differences exact. Squares, for the deviation, are summed as decimals around the middle of the group's values, in
steps of 2^-50 of their range; groups of up to 70 million rows can't overflow them.

Least and greatest can't be subtracted. The axis is cut into blocks as wide as the frame, so a frame covers the end of one block and the
beginning of the next: the best of the block so far, and the best from the frame's start to its block's end, both running values again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeaxis import floor_div

_LIMB = 32
_SUM_BITS = 61  # a double down to 2^-8 of the greatest is a whole number then, without rounding
_SQUARE_BITS = 50


@dataclass(frozen=True)
class Frame:
    """`stat` of `column` over (axis - width, axis], or without the current place: (axis - width, axis)."""

    column: str
    width: int
    stat: str
    include_current: bool = True
    min_count: int = 1


def _finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


def _scale(top: Column, bits: int) -> Column:
    """The power of two that brings numbers up to `top` near 2^bits; 1 where there are none."""
    exponent = F.least(bits - 1 - F.floor(F.log2(top)), F.lit(1000))
    return F.when(top > 0, F.pow(F.lit(2.0), exponent)).otherwise(F.lit(1.0))


def with_frames(df: DataFrame, group: Sequence[str], axis: str, frames: dict[str, Frame]) -> DataFrame:
    """`df` with one column for each frame. `axis` is a whole number; rows with equal ones are in each other's frames."""
    up = Window.partitionBy(*group).orderBy(axis)
    whole = Window.partitionBy(*group)
    kinds = {f.name: f.dataType for f in df.schema}
    columns = df.columns

    made: dict[tuple, Column] = {}

    def upto(what: str, value: Column, bound: int) -> Column:
        """The running value of all up to `bound` from the row, one window expression for all that need it."""
        made.setdefault((what, bound), value.over(up.rangeBetween(Window.unboundedPreceding, bound)))
        return F.coalesce(F.col(f"__{what}@{bound}"), F.lit(0))

    def seen(what: str, value: Column, f: Frame) -> Column:
        what = f"{what}_{f.column}"
        return upto(what, value, 0 if f.include_current else -1) - upto(what, value, -f.width)

    # what the group's values need: their scale, their middle
    def named(stats: tuple[str, ...], *types: type) -> list[str]:
        return sorted({f.column for f in frames.values() if f.stat in stats and isinstance(kinds[f.column], types)})

    floats = named(("sum", "mean"), T.DoubleType, T.FloatType)
    spread = named(("std",), T.DataType)
    extent: dict[str, Column] = {}
    for c in floats:
        extent[f"__top_{c}"] = F.max(F.when(_finite(F.col(c)), F.abs(F.col(c).cast("double")))).over(whole)
    for c in spread:
        x = F.col(c).cast("double")
        extent[f"__low_{c}"] = F.min(F.when(_finite(x), x)).over(whole)
        extent[f"__high_{c}"] = F.max(F.when(_finite(x), x)).over(whole)
    work = df.select("*", *[e.alias(n) for n, e in extent.items()]) if extent else df

    added: dict[str, Column] = {}
    for c in floats:
        x = F.col(c).cast("double")
        added[f"__s_{c}"] = _scale(F.col(f"__top_{c}"), _SUM_BITS)
        added[f"__q_{c}"] = F.when(_finite(x), F.rint(x * _scale(F.col(f"__top_{c}"), _SUM_BITS)).cast("long"))
    for c in named(("sum", "mean"), T.IntegralType):
        added[f"__q_{c}"] = F.col(c).cast("long")
    for c in spread:
        x = F.col(c).cast("double")
        half = F.col(f"__high_{c}") / 2 - F.col(f"__low_{c}") / 2
        middle = F.col(f"__low_{c}") / 2 + F.col(f"__high_{c}") / 2
        added[f"__t_{c}"] = _scale(half, _SQUARE_BITS)
        added[f"__y_{c}"] = F.when(_finite(x), F.rint((x - middle) * _scale(half, _SQUARE_BITS)).cast("decimal(16,0)"))
    work = work.select("*", *[e.alias(n) for n, e in added.items()]) if added else work
    ends, work = _ends(work, group, axis, frames)

    def odd(f: Frame, value: Column) -> Column:
        """`value`, unless the frame has infinities or NaN."""
        x = F.col(f.column).cast("double")
        n = seen("odd", F.count(F.when(~_finite(x), 1)), f)
        signed = seen("signed", F.sum(F.when(x == float("inf"), 1).when(x == float("-inf"), -1).otherwise(0)), f)
        return F.when(n == 0, value).when(n == signed, float("inf")).when(n == -signed, float("-inf")).otherwise(float("nan"))

    def result(name: str, f: Frame) -> Column:
        c, kind = F.col(f.column), kinds[f.column]
        n = seen("n", F.count(c), f)
        if f.stat == "count":
            out = n
        elif f.stat in ("min", "max"):
            out = ends[name]
        elif f.stat == "std":
            y = F.col(f"__y_{f.column}")
            total, squares = seen("y", F.sum(y), f).cast("decimal(30,0)"), seen("yy", F.sum((y * y).cast("decimal(31,0)")), f).cast("decimal(38,0)")
            # around the whole part m of the mean: S = sum (y - m)^2 = squares - m (total + rest), and n times (mean - m)^2 off
            m = F.call_function("div", total, n.cast("decimal(19,0)"))
            rest = total - (m.cast("decimal(16,0)") * n.cast("decimal(13,0)"))
            around = (squares - (m.cast("decimal(16,0)") * (total + rest).cast("decimal(24,0)")).cast("decimal(38,0)")).cast("double")
            part = rest.cast("double")
            variance = F.greatest(around - part * part / n, F.lit(0.0)) / (n - 1)
            finite = F.when(n > 1, F.sqrt(variance) / F.col(f"__t_{f.column}"))
            out = F.when(n == 1, F.lit(None).cast("double")).when(seen("odd", F.count(F.when(~_finite(c.cast("double")), 1)), f) == 0, finite).otherwise(float("nan"))
        elif isinstance(kind, T.DecimalType):
            total = seen("sum", F.sum(c), f)
            out = total.cast(T.DecimalType(min(38, kind.precision + 10), kind.scale)) if f.stat == "sum" else (total / n).cast(
                T.DecimalType(min(38, kind.precision + 4), min(37, kind.scale + 4)))
        else:
            q = F.col(f"__q_{f.column}")
            high, low = seen("high", F.sum(F.shiftright(q, _LIMB)), f), seen("low", F.sum(q.bitwiseAND(F.lit((1 << _LIMB) - 1))), f)
            if isinstance(kind, T.IntegralType):
                out = high * F.lit(1 << _LIMB) + low if f.stat == "sum" else (high * float(1 << _LIMB) + low) / n
            else:
                total = (high * float(1 << _LIMB) + low) / F.col(f"__s_{f.column}")
                out = odd(f, total if f.stat == "sum" else total / n)
        if f.stat == "count":
            return out if f.min_count <= 1 else F.when(n >= f.min_count, out)
        return F.when(n >= max(1, f.min_count), out)

    results = [result(n, f).alias(n) for n, f in frames.items()]
    work = work.select("*", *[e.alias(f"__{what}@{bound}") for (what, bound), e in made.items()])
    return work.select(*columns, *results)


def _ends(df: DataFrame, group: Sequence[str], axis: str, frames: dict[str, Frame]) -> tuple[dict[str, Column], DataFrame]:
    """The least and greatest of frames as columns over the returned frame."""
    wanted = {n: f for n, f in frames.items() if f.stat in ("min", "max")}
    if not wanted:
        return {}, df
    up, down = Window.partitionBy(*group).orderBy(axis), Window.partitionBy(*group).orderBy(F.desc(axis))

    def block(f: Frame) -> Column:
        return floor_div(F.col(axis), f.width)

    def best(f: Frame, sign: int) -> tuple[Column, Column]:
        """(aggregate, value) whose best is the latest block's best value: a null never wins."""
        c = F.col(f.column)
        if f.stat == "max":
            return F.max, F.struct((block(f) * sign).alias("b"), c.isNotNull().alias("z"), c.alias("v"))
        return F.min, F.struct((block(f) * -sign).alias("b"), c.isNull().alias("z"), c.alias("v"))

    tails = {n: (a := best(f, -1))[0](a[1]).over(down.rangeBetween(Window.unboundedPreceding, 0)) for n, f in wanted.items()}
    work = df.select("*", *[e.alias(f"__tail_{n}") for n, e in tails.items()])
    work = work.select("*", *[F.lead(f"__tail_{n}").over(up).alias(f"__next_{n}") for n in wanted])
    made = {}
    for n, f in wanted.items():
        fn, value = best(f, 1)
        outside = up.rangeBetween(Window.unboundedPreceding, -f.width)
        first = F.first(f"__tail_{n}").over(up.rangeBetween(Window.unboundedPreceding, 0))
        edge = F.when(F.count(F.lit(1)).over(outside) > 0, F.last(f"__next_{n}").over(outside)).otherwise(first)
        made[f"__head_{n}"] = fn(value).over(up.rangeBetween(Window.unboundedPreceding, 0 if f.include_current else -1))
        made[f"__edge_{n}"] = edge
    work = work.select("*", *[e.alias(k) for k, e in made.items()])
    out = {}
    for n, f in wanted.items():
        head, edge = F.col(f"__head_{n}"), F.col(f"__edge_{n}")
        sign = 1 if f.stat == "max" else -1
        parts = [F.when(head["b"] == block(f) * sign, head["v"]), F.when(edge["b"] == (block(f) - 1) * -sign, edge["v"])]
        out[n] = F.greatest(*parts) if f.stat == "max" else F.least(*parts)
    return out, work
