"""Roll-ups: slots, days, months, years, mixes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_parts, is_weekend, season
from ..functions.measures import energy_gwh, mean_of
from ..functions.timeaxis import micros, slot_start


def resample(df: DataFrame, time: str, width: int, aggregates: Mapping[str, Column],
             keys: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """One row per fixed-width slot; the aggregates shrink the rows before the shuffle."""
    slot = slot_start(time, width).alias(name or time)
    return df.groupBy(*keys, slot).agg(*[a.alias(n) for n, a in aggregates.items()])


@dataclass(frozen=True)
class DailySpec:
    """Column names of a clean series, and how long one reading stands for."""

    time: str = "datetime"
    load: str = "consumption_mw"
    sources: Mapping[str, str] = field(default_factory=lambda: {
        "nuclear_mean_mw": "nuclear_mw", "wind_mean_mw": "wind_mw",
        "solar_mean_mw": "solar_mw", "hydro_mean_mw": "hydro_mw"})
    renewable_share: str = "renewable_share_pct"
    nuclear_share: str = "nuclear_share_pct"
    error: str = "forecast_error_mw"
    error_pct: str = "forecast_error_pct"
    co2: str = "co2_rate"
    imputed: str = "is_interpolated"
    score: str = "quality_score"
    exchanges: str | None = "physical_exchanges_mw"
    exports_negative: bool = True
    cadence_hours: float = 0.5
    keys: tuple[str, ...] = ()


def peak_of_day(load: str, time: str) -> Column:
    """Struct (value, hour) of the highest load; the earliest time wins a tie."""
    top = F.max(F.when(F.col(load).isNotNull(),
                       F.struct(F.col(load).alias("value"), (-micros(time)).alias("t"), F.hour(time).alias("hour"))))
    return top


def off_peak_mean(load: str, peak_flag: Column) -> Column:
    return mean_of(F.when(~peak_flag, F.col(load)))


def net_export_gwh(exchanges: str, cadence_hours: float, exports_negative: bool = True) -> Column:
    total = energy_gwh(F.sum(exchanges), cadence_hours)
    return -total if exports_negative else total


def daily_rollup(df: DataFrame, spec: DailySpec = DailySpec()) -> DataFrame:
    """Per day: load statistics, energy, forecast error, mix, CO2, quality and peak, in one pass.

    Grouping is by day alone (year, month and the like follow from it), and the peak is an
    aggregate, so there is one scan, one shuffle, and no window or join. Columns the input
    lacks are left out.
    """
    have = set(df.columns)
    day = F.to_date(F.col(spec.time)).alias("date")
    aggs: dict[str, Column] = {
        "consumption_mean_mw": mean_of(spec.load),
        "consumption_min_mw": F.min(spec.load),
        "consumption_max_mw": F.max(spec.load),
        "consumption_std_mw": F.stddev_samp(spec.load),
        "consumption_total_gwh": energy_gwh(F.sum(spec.load), spec.cadence_hours),
    }
    if "is_peak_hour" in have:
        aggs["off_peak_mean_mw"] = off_peak_mean(spec.load, F.col("is_peak_hour"))
    if spec.error_pct in have:
        aggs["forecast_mape_pct"] = mean_of(spec.error_pct)
    if spec.error in have:
        aggs["forecast_mae_mw"] = mean_of(F.abs(F.col(spec.error)))
    aggs |= {n: mean_of(c) for n, c in spec.sources.items() if c in have}
    aggs |= {c: mean_of(c) for c in (spec.renewable_share, spec.nuclear_share) if c in have}
    if spec.co2 in have:
        aggs |= {"co2_mean_gkwh": mean_of(spec.co2), "co2_min_gkwh": F.min(spec.co2), "co2_max_gkwh": F.max(spec.co2)}
    if spec.exchanges and spec.exchanges in have:
        aggs["net_export_gwh"] = net_export_gwh(spec.exchanges, spec.cadence_hours, spec.exports_negative)
    aggs["records_count"] = F.count(F.lit(1))
    if spec.imputed in have:
        aggs["interpolated_count"] = F.count(F.when(F.col(spec.imputed), 1))
    if spec.score in have:
        aggs["quality_score_mean"] = mean_of(spec.score)

    out = df.groupBy(*spec.keys, day).agg(peak_of_day(spec.load, spec.time).alias("__peak"),
                                          *[a.alias(n) for n, a in aggs.items()])
    parts = calendar_parts("date")
    return out.select(
        *spec.keys, "date", parts["year"].alias("year"), parts["month"].alias("month"),
        parts["day_of_week"].alias("day_of_week"), season("date").alias("season"),
        is_weekend("date").alias("is_weekend"), *aggs,
        F.col("__peak.hour").alias("peak_hour"), F.col("__peak.value").alias("peak_consumption_mw"))


def daily_peak(df: DataFrame, time: str, load: str, keys: Sequence[str] = ()) -> DataFrame:
    return (df.groupBy(*keys, F.to_date(F.col(time)).alias("date"))
            .agg(peak_of_day(load, time).alias("p"))
            .select(*keys, "date", F.col("p.hour").alias("peak_hour"), F.col("p.value").alias("peak_value")))


def left_join_peak(daily: DataFrame, peaks: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Peaks joined to their day, for peaks that come from another table than the day rows."""
    return daily.join(peaks, [*keys, "date"], "left")


def year_on_year(df: DataFrame, value: str, year: str = "year", season_keys: Sequence[str] = ("month",),
                 name: str = "consumption_yoy_pct", adjacent_only: bool = True) -> DataFrame:
    """Change in percent on the same period a year before.

    `adjacent_only` compares with the year before and nothing else; without it the previous
    row counts even if years are missing in between.
    """
    order = Window.partitionBy(*season_keys).orderBy(year)
    previous = F.lag(value).over(order)
    if adjacent_only:
        previous = F.when(F.lag(year).over(order) == F.col(year) - 1, previous)
    return df.withColumn(name, F.try_divide(F.col(value) - previous, previous) * 100)


def monthly_rollup(daily: DataFrame, adjacent_only: bool = True) -> DataFrame:
    """Per month: mean of the daily means, energy, shares, CO2, days, change on a year before."""
    have = set(daily.columns)
    aggs = {
        "consumption_mean_mw": mean_of("consumption_mean_mw"),
        "consumption_total_twh": F.sum("consumption_total_gwh").cast("double") / 1000,
    }
    for name, source in (("renewable_pct", "renewable_share_pct"), ("nuclear_share_pct", "nuclear_share_pct"),
                         ("co2_mean_gkwh", "co2_mean_gkwh")):
        if source in have:
            aggs[name] = mean_of(source)
    aggs["trading_days"] = F.count("date")
    out = daily.groupBy("year", "month").agg(*[a.alias(n) for n, a in aggs.items()])
    out = out.select("year", "month", season(F.make_date("year", "month", F.lit(1))).alias("season"), *aggs)
    return year_on_year(out, "consumption_total_twh", adjacent_only=adjacent_only)


def source_energy_by_month(df: DataFrame, time: str, sources: Mapping[str, str],
                           cadence_hours: float = 0.5) -> DataFrame:
    """Energy of each source per month, GWh."""
    return df.groupBy(F.year(time).alias("year"), F.month(time).alias("month")).agg(
        *[energy_gwh(F.sum(c), cadence_hours).alias(n) for n, c in sources.items()])


def colour_days(calendar: DataFrame, day: str, colour: str, colours: Sequence[str]) -> DataFrame:
    """Days of each calendar colour per month."""
    return calendar.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        *[F.count(F.when(F.col(colour) == c, 1)).alias(f"{c.lower()}_days") for c in colours])


def calendar_join(df: DataFrame, calendar: DataFrame, time: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Day attributes onto rows. A calendar has one row per day (checked by `keep_first` upstream),
    so Spark's own size estimate decides whether it is broadcast."""
    days = calendar.select(F.col(day).alias("__day"), *columns)
    return df.withColumn("__day", F.to_date(F.col(time))).join(days, "__day", "left").drop("__day")


def annual_summary(daily: DataFrame, monthly: DataFrame, daily_aggs: Mapping[str, Column],
                   monthly_aggs: Mapping[str, Column]) -> DataFrame:
    """Yearly figures of the daily table full-joined with yearly figures of the monthly table."""
    d = daily.groupBy("year").agg(*[a.alias(n) for n, a in daily_aggs.items()])
    m = monthly.groupBy("year").agg(*[a.alias(n) for n, a in monthly_aggs.items()])
    return d.join(m, "year", "full").orderBy("year")


def annual_energy(annual: DataFrame, value: str = "consumption_twh") -> DataFrame:
    return annual.filter(F.col(value).isNotNull()).select("year", F.round(value, 2).alias(value)).orderBy("year")


def mix_by_source(df: DataFrame, sources: Mapping[str, str], digits: int | None = 0,
                  metric: str = "metric", value: str = "value") -> DataFrame:
    """Mean of each source as one row per source; one aggregate, then unpivoted."""
    means = {n: mean_of(c) for n, c in sources.items()}
    if digits is not None:
        means = {n: F.round(m, digits) for n, m in means.items()}
    return df.agg(*[m.alias(n) for n, m in means.items()]).unpivot([], list(means), metric, value)


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n")
        out = row if out is None else out.unionAll(row)
    return out


def rows_per_day(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.to_date(F.col(time)).alias("date")).agg(F.count(F.lit(1)).alias("n"))
