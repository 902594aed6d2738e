"""Raw against cleaned data: how each point changed, and by how much."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import LOAD_MAX, LOAD_MIN
from ..functions.calendar import hours_in_month, month_label
from ..functions.measures import is_outlier, mean_of
from ..functions.timeaxis import MINUTE
from .dedupe import keep_last_in_slot

SLOT = 30 * MINUTE


def compare_outer(raw: DataFrame, clean: DataFrame, time: str, value: str,
                  imputed: str | None = None, slot: int = SLOT, tie_break: Sequence[str] = ()) -> DataFrame:
    """Full join of raw and clean on the time slot; both sides hold one row per slot.

    Rows of one instant go by `tie_break` (columns of both sides), then by value, nulls first, so that both
    sides choose alike whatever order they come in.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        keep = [F.col(time), F.col(value), *[F.col(c) for c in tie_break]]
        if name == "clean":
            flag = F.col(imputed) if imputed in df.columns else F.lit(False)
            keep.append(flag.alias("is_interpolated"))
        one = keep_last_in_slot(df.select(*keep), time, slot, tie_break=[*tie_break, value])
        return one.drop(*tie_break).withColumnRenamed(value, f"{value}_{name}")

    return side(raw, "raw").join(side(clean, "clean"), time, "full")


def classify_corrections(pairs: DataFrame, value: str, low: float = LOAD_MIN, high: float = LOAD_MAX) -> DataFrame:
    """Each compared point as unchanged, minor, major or removed."""
    raw, clean = F.col(f"{value}_raw"), F.col(f"{value}_clean")
    raw_odd = is_outlier(raw, low, high)
    change = F.abs(raw - clean) / F.greatest(F.abs(raw), F.lit(1.0))
    touched = F.coalesce(F.col("is_interpolated"), F.lit(False)) | raw_odd | (change > 0.01)
    kind = (F.when(raw.isNull() & clean.isNull(), "unchanged")
            .when(clean.isNull(), "removed")
            .when(raw.isNull(), "minor")
            .when(raw_odd & ~is_outlier(clean, low, high), "removed")
            .when(change > 0.05, "major")
            .when(touched, "minor")
            .otherwise("unchanged"))
    return pairs.withColumn("correction", kind)


def correction_summary(classified: DataFrame, value: str, raw: DataFrame, time: str, slot: int = SLOT) -> DataFrame:
    """Counts and percentages of changed points, with raw and de-duplicated row numbers."""
    kind = F.col("correction")
    slots = keep_last_in_slot(raw.select(time), time, slot)
    n_raw = raw.agg(F.count(F.lit(1))).scalar()
    n_dedup = slots.agg(F.count(F.lit(1))).scalar()
    c = classified.agg(
        F.count(F.lit(1)).alias("n"), F.count(f"{value}_clean").alias("n_clean"),
        F.count(F.when(kind != "unchanged", 1)).alias("n_modified"),
        F.count(F.when(kind == "minor", 1)).alias("n_minor"),
        F.count(F.when(kind == "removed", 1)).alias("n_removed"))
    return c.select(
        n_raw.alias("n_raw"), n_dedup.alias("n_dedup"), "n_clean", "n_modified",
        (F.col("n_modified") * 100.0 / F.greatest("n", F.lit(1))).alias("pct_modified"),
        (F.col("n_minor") * 100.0 / F.greatest("n_clean", F.lit(1))).alias("pct_imputed"),
        "n_removed", (n_raw - n_dedup).alias("duplicates"))


def corrections_per_day(classified: DataFrame, time: str) -> DataFrame:
    kinds = ("minor", "major", "removed")
    return classified.groupBy(F.to_date(F.col(time)).alias("date")).agg(
        *[F.count(F.when(F.col("correction") == k, 1)).alias(k) for k in kinds])


def volume_summary(raw: DataFrame, clean: DataFrame, time: str) -> DataFrame:
    """Raw, clean, duplicated and removed row numbers, and the share of raw rows kept."""
    per_time = raw.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
    r = per_time.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
                     F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    out = r.select("raw", clean.agg(F.count(F.lit(1))).scalar().alias("clean"), "duplicates")
    return out.select(
        "*", F.greatest(F.col("raw") - F.col("duplicates") - F.col("clean"), F.lit(0)).alias("removed"),
        (F.col("clean") * 100.0 / F.greatest("raw", F.lit(1))).alias("retention_pct"))


def monthly_energy_mean(df: DataFrame, time: str, value: str) -> DataFrame:
    """Month energy as mean power times the hours of the month, TWh."""
    month = F.to_date(F.date_trunc("month", F.col(time)))
    means = df.groupBy(month.alias("period")).agg(mean_of(value).alias("m")).filter("m is not null")
    return means.select("period", month_label("period").alias("label"),
                        (F.col("m") * hours_in_month("period") / 1_000_000).alias("total_twh"))


def month_inner(raw_months: DataFrame, clean_months: DataFrame) -> DataFrame:
    r = raw_months.select("label", F.col("total_twh").alias("raw_twh"))
    c = clean_months.select("label", F.col("total_twh").alias("clean_twh"))
    return r.join(c, "label")


def monthly_compare(raw_months: DataFrame, clean_months: DataFrame) -> DataFrame:
    """Month by month gap in percent, with the flags that call for a label or a cause."""
    gap = F.when(F.col("raw_twh") > 0, (F.col("clean_twh") - F.col("raw_twh")) / F.col("raw_twh") * 100)
    out = month_inner(raw_months, clean_months).withColumn("gap_pct", gap)
    return out.select("*", (F.abs("gap_pct") >= 1.0).alias("annotate"), (F.abs("gap_pct") >= 3.0).alias("explain"))


def monthly_gap_summary(compared: DataFrame) -> DataFrame:
    """Mean absolute gap, and the month with the largest one (the earliest wins a tie)."""
    worst = F.max(F.when(F.col("gap_pct") != 0, F.struct(
        F.abs("gap_pct").alias("size"), (-F.unix_date(F.to_date(F.concat("label", F.lit("-01"))))).alias("t"),
        "label", "gap_pct", "raw_twh", "clean_twh", "explain")))
    row = compared.agg(mean_of(F.abs(F.try_divide("gap_pct", F.lit(1)))).alias("mean_abs_gap_pct"), worst.alias("w"))
    return row.select("mean_abs_gap_pct", F.col("w.label").alias("max_gap_month"), F.col("w.gap_pct").alias("max_gap_pct"),
                      F.col("w.raw_twh"), F.col("w.clean_twh"), F.col("w.explain").alias("explain"))


def linear_trend(df: DataFrame, order: str, value: str, min_points: int = 3) -> DataFrame:
    """Least-squares line through the values at positions 0, 1, 2 ... in `order`.

    For tables of one row per period (months), where one ordered window is small by nature.
    """
    pos = df.select(value, (F.row_number().over(Window.orderBy(order)) - 1).cast("double").alias("x"))
    y = F.col(value).cast("double")
    return pos.agg(F.regr_slope(y, F.col("x")).alias("slope"), F.regr_intercept(y, F.col("x")).alias("intercept"),
                   F.count(value).alias("n")).filter(F.col("n") >= min_points)
