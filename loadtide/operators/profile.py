"""Column profiles, histograms and density estimates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import LOAD_MAX, LOAD_MIN
from ..functions.calendar import month_label
from ..functions.measures import is_outlier, mean_of


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, filled rows, share filled. One aggregate for all columns."""
    row = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    return row.unpivot(["__n"], list(columns), "column_name", "filled").select(
        "column_name", F.col("__n").alias("n"), "filled",
        F.try_divide(F.col("filled"), F.col("__n")).alias("completeness"))


def anomaly_heatmap(df: DataFrame, time: str, columns: Sequence[str], bounded: dict[str, tuple[float, float]] | None = None,
                    period: Column | None = None, top: int = 6) -> DataFrame:
    """Percent of bad cells per period and column, for the `top` columns with the highest mean rate.

    Bad is null, or out of range for the columns in `bounded`. Equal rates go by column name.
    """
    bounded = bounded or {}
    bad = {c: is_outlier(c, *bounded[c]) if c in bounded else F.col(c).isNull() for c in columns}
    per_period = df.groupBy((period if period is not None else month_label(time)).alias("period")).agg(
        *[mean_of(f.cast("int")).alias(c) for c, f in bad.items()])
    cells = per_period.unpivot(["period"], list(columns), "column_name", "rate")
    worst = (cells.groupBy("column_name").agg(mean_of("rate").alias("m"))
             .orderBy(F.col("m").desc(), "column_name").limit(top).select("column_name"))
    return cells.join(worst, "column_name", "left_semi").select("column_name", "period", (F.col("rate") * 100).alias("rate_pct"))


def describe_load(df: DataFrame, value: str, low: float = LOAD_MIN, high: float = LOAD_MAX) -> DataFrame:
    """Mean, population standard deviation, extremes and out-of-range count of the filled values."""
    v = F.col(value)
    return df.agg(mean_of(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).cast("double").alias("min"),
                  F.max(v).cast("double").alias("max"),
                  F.count(F.when(v.isNotNull() & is_outlier(v, low, high), 1)).alias("outliers"))


def describe_before_after(before: DataFrame, after: DataFrame, value: str, low: float = LOAD_MIN,
                          high: float = LOAD_MAX) -> DataFrame:
    """One row per statistic: before, after, change in percent (null from zero)."""
    names = ["mean", "std", "min", "max", "outliers"]

    def tall(df: DataFrame, name: str) -> DataFrame:
        d = describe_load(df, value, low, high)
        return d.select(*[F.col(c).cast("double") for c in names]).unpivot([], names, "statistic", name)

    b, a = F.col("before"), F.col("after")
    return tall(before, "before").join(tall(after, "after"), "statistic").withColumn(
        "change_pct", F.when(b != 0, (a - b) / b * 100))


def quality_categories(df: DataFrame, columns: Sequence[str], load: str, low: float = 0.0,
                       high: float = LOAD_MAX, min_score: float | None = None) -> DataFrame:
    """Percent of rows that are valid, missing a value, out of range, or partial.

    With no `min_score` any null means missing and nothing is partial. With one, rows that
    keep at least that share of their values (and the load) count as partial.
    """
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNotNull().cast("int"))
    score = filled / F.lit(len(columns))
    lacking = F.col(load).isNull() | (score < (1.0 if min_score is None else min_score))
    odd = ~F.col(load).between(low, high)
    kind = (F.when(lacking, "missing").when(odd, "outlier").when(score < 1.0, "partial").otherwise("valid"))
    n = F.count(F.lit(1))
    return df.select(kind.alias("k")).agg(
        *[F.try_divide(F.count(F.when(F.col("k") == k, 1)) * 100.0, n).alias(f"{k}_pct")
          for k in ("valid", "missing", "outlier", "partial")])


def histogram_density(df: DataFrame, value: str, bins: int = 45, min_rows: int = 20) -> DataFrame:
    """Equal-width bins between the extremes (last one closed): count and density.

    Empty bins are left out. Needs more than `min_rows` values.
    """
    v = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    low, high, n = (v.agg(a).scalar() for a in (F.min("v"), F.max("v"), F.count("v")))
    width = (high - low) / bins
    place = F.when(high > low, F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = v.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total, left, w = n.alias("total"), low, width
    return counts.filter(n > min_rows).select(
        "bin", (left + F.col("bin") * w).alias("bin_low"), "n",
        F.try_divide(F.col("n").cast("double"), total * w).alias("density"))


_ORDER = 14


def _hermite(order: int) -> list[list[float]]:
    """Coefficients of the (probabilists') Hermite polynomials up to `order`, lowest power first."""
    out = [[1.0], [0.0, 1.0]]
    for j in range(1, order - 1):
        shifted, before = [0.0, *out[j]], out[j - 1]
        out.append([c - (j * before[m] if m < len(before) else 0.0) for m, c in enumerate(shifted)])
    return out[:order]


def kde(df: DataFrame, value: str, points: int = 1000, bin_width: float | None = None) -> DataFrame:
    """Gaussian density estimate with Scott's bandwidth h, on a grid half a range wider at both ends.

    Values are gathered in cells a quarter of h wide, in the map tasks, as sums of powers of their distance u from the cell's middle
    (in units of h, at most 1/8). A cell's share at a grid point at distance t is the expansion of exp(-(t - u)^2 / 2) in Hermite polynomials,
    exp(-t^2 / 2) * sum of u^j / j! * He_j(t) for j < 14. What is left out is at most 1.1 * (1/8)^14 / sqrt(14!) of a value's share, or
    1e-18 of it: below the rounding of doubles next to the peak. So the cost is the number of cells (range / h * 4) times the grid points within 39 bandwidths (beyond,
    the share is zero in doubles), however many distinct values there are. Grid points out of reach of all values have density 0.
    A single value, or equal ones, have no bandwidth: the density is null. `bin_width` takes values at the middle of such bins.
    """
    v = df.select(F.col(value).cast("double").alias("v")).filter("v is not null")
    if bin_width is not None:
        v = v.select(((F.floor(F.col("v") / bin_width) + 0.5) * bin_width).alias("v"))
    s = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").cast("double").alias("n"), F.stddev_samp("v").alias("s"))
    p = s.select(F.struct(
        (F.col("lo") - 0.5 * (F.col("hi") - F.col("lo"))).alias("g0"), (2.0 * (F.col("hi") - F.col("lo")) / (points - 1)).alias("dg"), "n",
        F.when(F.col("s") > 0, F.col("s") * F.pow(F.col("n"), F.lit(-0.2))).alias("h"))).scalar()
    cell = F.floor(F.col("v") / F.col("p.h") * 4)
    near = v.withColumn("p", p).filter("p.h is not null").select("p", cell.alias("cell"), (F.col("v") / F.col("p.h") - (cell + 0.5) / 4).alias("u"))
    power, moments = F.lit(1.0), []
    for j in range(_ORDER):
        moments.append((F.sum(power) / math.factorial(j)).alias(f"m{j}"))
        power = power * F.col("u")
    cells = near.groupBy("p", "cell").agg(*moments)
    hermite = _hermite(_ORDER)  # gathered by powers of t
    terms = [reduce(lambda a, b: a + b, [F.col(f"m{j}") * he[m] for j, he in enumerate(hermite) if m < len(he) and he[m]]) for m in range(_ORDER)]
    middle = (F.col("cell") + 0.5) / 4 * F.col("p.h")
    place = lambda side: (middle + side * 40.0 * F.col("p.h") - F.col("p.g0")) / F.col("p.dg")
    low, high = F.greatest(F.floor(place(-1)).cast("int"), F.lit(0)), F.least(F.ceil(place(1)).cast("int"), F.lit(points - 1))
    cells = cells.select("p", middle.alias("at"), *[c.alias(f"a{m}") for m, c in enumerate(terms)], F.explode(F.sequence(low, high)).alias("i"))
    x = F.col("p.g0") + F.col("i") * F.col("p.dg")
    share = reduce(lambda a, m: a * F.col("t") + F.col(f"a{m}"), range(_ORDER - 2, -1, -1), F.col(f"a{_ORDER - 1}"))
    shares = cells.withColumn("t", (x - F.col("at")) / F.col("p.h")).select("i", "p", (share * F.exp(-0.5 * F.col("t") * F.col("t"))).alias("m"))
    every = df.sparkSession.range(points).select(F.col("id").cast("int").alias("i"), p.alias("p"), F.lit(0.0).alias("m")).filter("p.n > 0")
    return shares.unionByName(every).groupBy("i", "p").agg(F.sum("m").alias("mass")).select(
        F.col("i").alias("grid_index"), x.alias("x"),
        (F.col("mass") / (F.col("p.n") * F.col("p.h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))
