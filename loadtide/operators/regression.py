"""Prediction errors, rankings and smooth bias curves as aggregates over prediction rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import MODEL_LABELS
from ..functions.measures import label_map, mean_of
from ..functions.timeaxis import HOUR
from .islands import label_segments


def error_metrics(actual: str, predicted: str, positive_only: bool = True) -> dict[str, Column]:
    """RMSE, MAE, MAPE and R2 as plain aggregates, so one pass gives all of them.

    MAPE is over positive labels, or over all labels but zero.
    """
    a, e = F.col(actual), F.col(actual) - F.col(predicted)
    base = F.when(a > 0, a) if positive_only else F.when(a != 0, a)
    n = F.count(e).cast("double")
    both = F.when(e.isNotNull(), a)
    return {
        "rmse": F.sqrt(F.try_divide(F.sum(e * e), n)),
        "mae": F.try_divide(F.sum(F.abs(e)), n),
        "mape_pct": F.avg(F.abs(e) / base) * 100,
        "r2": 1 - F.try_divide(F.sum(e * e), F.nullif(F.var_pop(both) * n, F.lit(0.0))),
    }


def evaluate(predictions: DataFrame, actual: str, predicted: str, keys: Sequence[str] = (),
             positive_only: bool = True) -> DataFrame:
    return predictions.groupBy(*keys).agg(
        *[m.alias(n) for n, m in error_metrics(actual, predicted, positive_only).items()])


def error_band(predictions: DataFrame, actual: str, predicted: str, width: float = 2.0) -> DataFrame:
    """Each row: error, inside the band of `width` times RMSE or not, and its direction."""
    e = F.col(actual) - F.col(predicted)
    clean = predictions.filter(e.isNotNull())
    band = clean.agg(F.sqrt(F.avg(e * e)) * width).scalar()
    return clean.select("*", e.alias("error"), (F.abs(e) <= band).alias("in_band"),
                        F.when(e > 0, "under").otherwise("over").alias("direction"))


def segment_mae(predictions: DataFrame, time: str, actual: str, predicted: str, gap: int = 24 * HOUR,
                keys: Sequence[str] = ()) -> DataFrame:
    """Error, size and bounds of every contiguous block of predictions."""
    e = F.abs(F.col(actual) - F.col(predicted))
    return label_segments(predictions.filter(e.isNotNull()), time, gap, keys).groupBy(*keys, "segment_id").agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("segment_start"), F.max(time).alias("segment_end"),
        F.avg(e).alias("mae"))


def model_ranking(metrics: DataFrame, labels: Mapping[str, str] = MODEL_LABELS) -> DataFrame:
    """Models by error: change against the best, relative bars, and the best of every metric."""
    everything = Window.partitionBy()
    order = Window.orderBy("rmse", "model_name")
    best_rmse, best_r2 = F.min("rmse").over(everything), F.max("r2").over(everything)
    name = label_map("model_name", labels, F.replace(F.col("model_name"), F.lit("_"), F.lit(" ")))
    out = metrics.select(
        "model_name", name.alias("label"), "rmse", "mae", "mape_pct", "r2",
        F.row_number().over(order).alias("rank"),
        ((F.try_divide("rmse", best_rmse) - 1) * 100).alias("delta_rmse_pct"),
        (F.try_divide("rmse", best_rmse) * 100).alias("rmse_pct_of_best"),
        ((1 - F.col("r2")) / F.greatest(1 - best_r2, F.lit(1e-6)) * 100).alias("r2_gap_pct"),
        (F.col("rmse") == best_rmse).alias("best_rmse"),
        (F.col("mae") == F.min("mae").over(everything)).alias("best_mae"),
        (F.col("mape_pct") == F.min("mape_pct").over(everything)).alias("best_mape"),
        (F.col("r2") == best_r2).alias("best_r2"))
    return out


def model_narrative(metrics: DataFrame, linear: str = "linear", boosted: str = "gradient") -> DataFrame:
    """Error reduction of the best model against the linear one (or the worst), and what boosting costs."""
    def first(like: str, col: str) -> Column:
        hit = F.when(F.lower("model_name").contains(like), F.struct(F.col("rmse").alias("by"), F.col(col).alias("wanted")))
        return F.min(hit)["wanted"]

    r = metrics.agg(
        F.min(F.struct("rmse", "model_name", "train_time_s")).alias("best"), F.max(F.struct("rmse", "model_name")).alias("worst"),
        F.count(F.lit(1)).alias("n"), first(linear, "rmse").alias("lin"), first(linear, "model_name").alias("lin_name"),
        first(boosted, "rmse").alias("gb"), first(boosted, "train_time_s").alias("gb_s"))
    beats_linear = F.coalesce(F.col("lin") > F.col("best.rmse"), F.lit(False))
    base = F.when(beats_linear, F.col("lin")).when(F.col("n") >= 2, F.col("worst.rmse"))
    seconds = lambda c: F.coalesce(F.nullif(F.col(c), F.lit(0.0)), F.lit(1.0))
    return r.select(
        F.col("best.model_name").alias("best_model"),
        F.when(beats_linear, F.col("lin_name")).when(F.col("n") >= 2, F.col("worst.model_name")).alias("reference_model"),
        ((1 - F.try_divide(F.col("best.rmse"), base)) * 100).alias("error_reduction_pct"),
        ((F.try_divide(F.col("gb"), F.col("best.rmse")) - 1) * 100).alias("boosting_delta_pct"),
        F.when(F.col("gb").isNotNull(), seconds("gb_s") / F.greatest(seconds("best.train_time_s"), F.lit(0.1)))
        .alias("boosting_time_ratio"))


def curve_optimum(curve: DataFrame) -> DataFrame:
    """Point of the learning curve with the lowest validation error, and its gap to the training error."""
    best = F.min(F.struct("rmse_validation", "train_fraction", "train_rows", "rmse_train"))
    return curve.agg(best.alias("b")).select(
        F.col("b.train_fraction"), F.col("b.train_rows"), F.col("b.rmse_validation"),
        (F.col("b.rmse_validation") - F.col("b.rmse_train")).alias("gap"))


def nearest_distances(df: DataFrame, x: str, places: Sequence[float], rank: int, low: float, high: float, cells: int = 1024) -> list[float]:
    """For each place the distance of its `rank`-th nearest value, counted from 0, exactly.

    Rank search by counting. The values between `low` and `high` are counted in cells, of which only number, least and greatest
    value are kept; from each place the cells near and far ends bound the wanted distance from both sides. Cells that lie
    between these bounds and hold different values are cut into 256 and counted again, until the bounds meet. Every job
    aggregates in the map tasks, reads only values in cells still open, and hands the driver rows for these cells, a number that depends on
    the places and not on the data; each cut makes them 256 times narrower, so a handful of jobs does.
    """
    def cell(width: Column, start: Column, n: int) -> Column:
        return F.when(width > 0, F.least(F.floor((F.col("x") - start) / width * n), F.lit(n - 1))).otherwise(F.lit(0)).cast("long")

    rows = df.select(F.col(x).cast("double").alias("x")).filter("x is not null")
    rows = rows.withColumn("cell", cell(F.lit(high) - F.lit(low), F.lit(low), cells))
    at = np.asarray(places, float)
    known: dict[int, tuple] = {}
    ids = cells
    while True:
        for r in rows.groupBy("cell").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count(F.lit(1)).alias("n")).collect():
            known[r.cell] = (r.a, r.b, r.n)
        names = np.array(list(known))
        a, b, n = (np.array(c) for c in zip(*known.values()))
        found, left = [], set()
        for x0 in at:
            near = np.where(x0 < a, a - x0, np.where(x0 > b, x0 - b, 0.0))
            far = np.maximum(np.abs(a - x0), np.abs(b - x0))
            least, most = (d[o][np.searchsorted(np.cumsum(n[o]), rank + 1)] for d in (near, far) for o in (np.argsort(d, kind="stable"),))
            found.append(float(most))
            if least < most:
                left.update(names[(near <= most) & (far >= least) & (a < b)].tolist())
        if not left:
            return found
        cut = sorted(left)
        small = df.sparkSession.createDataFrame([(c, known[c][0], known[c][1], ids + 256 * i) for i, c in enumerate(cut)], "cell long, a double, b double, base long")
        rows = rows.join(small, "cell").select("x", (F.col("base") + cell(F.col("b") - F.col("a"), F.col("a"), 256)).alias("cell"))
        ids += 256 * len(cut)
        for c in cut:
            del known[c]


def loess(df: DataFrame, x: str, y: str, frac: float = 0.08, points: int = 300, tiny: float = 1e-12) -> DataFrame:
    """Local linear fit with tricube weights on an even grid between the extremes of `x`.

    The bandwidth at a grid point is its k-th nearest distance (see `nearest_distances`). A value then meets only the
    grid points whose bandwidth reaches it; the weighted sums are aggregates over the grid, combined in the map tasks. No task or
    group holds the data. Fewer than four rows are returned as they are (grid_index counts them).
    """
    data = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter(
        "x is not null and y is not null")
    s = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if s.n < 4:
        return data.select((F.row_number().over(Window.orderBy("x", "y")) - 1).cast("int").alias("grid_index"), "x", "y")
    lo, hi = F.lit(s.lo), F.lit(s.hi)
    k = min(max(int(frac * s.n), 3), s.n - 1)
    step = (hi - lo) / (points - 1)
    counted = data.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.sum("y").alias("sy"))
    grid = [s.lo + i * ((s.hi - s.lo) / (points - 1)) for i in range(points)]
    bandwidths = [max(h, 1e-9) for h in nearest_distances(data.select("x"), "x", grid, k, s.lo, s.hi)]
    reach = df.sparkSession.createDataFrame([(i, x0, h) for i, (x0, h) in enumerate(zip(grid, bandwidths))], "grid_index int, x0 double, h double")

    # The bandwidths are `points` rows: as one array they reach every row without a join. A value only meets the grid points
    # within the widest bandwidth, and counts where it lies in the point's own; beyond, the weight is 0.
    widths = reach.agg(F.sort_array(F.collect_list(F.struct("grid_index", "x0", "h")))).scalar()
    widest = F.lit(max(bandwidths))
    if s.hi > s.lo:
        low = F.greatest(F.floor((F.col("x") - widest - lo) / step).cast("int"), F.lit(0))
        high = F.least(F.ceil((F.col("x") + widest - lo) / step).cast("int"), F.lit(points - 1))
        near = F.slice(widths, low + 1, F.greatest(high - low + 1, F.lit(0)))
    else:
        near = widths
    pairs = counted.select("x", "c", "sy", F.explode(near).alias("g")).filter("abs(x - g.x0) <= g.h").select(
        "x", "c", "sy", "g.grid_index", "g.x0", "g.h", (F.col("x") - F.col("g.x0")).alias("u"))
    closeness = 1.0 - F.pow(F.abs("u") / F.col("h"), F.lit(3.0))
    w = F.pow(F.greatest(closeness, F.lit(0.0)), F.lit(3.0))
    sums = pairs.withColumn("w", w).groupBy("grid_index", "x0").agg(
        F.sum(F.col("w") * F.col("c")).alias("sw"), F.sum(F.col("w") * F.col("c") * F.col("u")).alias("su"),
        F.sum(F.col("w") * F.col("c") * F.col("u") * F.col("u")).alias("suu"),
        F.sum(F.col("w") * F.col("sy")).alias("swy"), F.sum(F.col("w") * F.col("u") * F.col("sy")).alias("suy"),
        F.min_by(F.col("sy") / F.col("c"), F.struct(F.abs("u"), F.col("x"))).alias("near"))
    um, ym = F.col("su") / F.col("sw"), F.col("swy") / F.col("sw")
    den, num = F.col("suu") - F.col("su") * um, F.col("suy") - F.col("su") * ym
    fit = F.when(F.col("sw") < tiny, F.col("near")).when(den < tiny, ym).otherwise(ym - F.try_divide(num, den) * um)
    return sums.select("grid_index", F.col("x0").alias("x"), fit.alias("y"))
