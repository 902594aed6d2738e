"""Raw (Bronze) to clean (Silver) to aggregated (Gold)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import FILLED_COLUMNS, LOAD_MAX, LOAD_MIN, MEASURE_COLUMNS, SCORE_COLUMNS, SILVER_COLUMNS
from ..functions.calendar import calendar_parts, cyclic, is_peak_hour, is_weekend, season
from ..functions.measures import completeness, forecast_error, forecast_error_pct, plain_share_pct, share_pct
from ..functions.timeaxis import HOUR, MINUTE
from ..operators.dedupe import keep_first
from ..operators.impute import fill_gaps
from ..operators.lookback import Lag, Rolling, row_windows, time_windows
from ..operators.rollup import DailySpec, daily_rollup, monthly_rollup, source_energy_by_month
from ..operators.select import available, available_columns, cast_numeric, range_filter_nullable, require_not_null
from ..sources.scratch import materialize


@dataclass(frozen=True)
class SeriesSpec:
    """Names and limits of a load series."""

    time: str = "datetime"
    load: str = "consumption_mw"
    forecast: str = "forecast_j1_mw"
    renewables: tuple[str, ...] = ("wind_mw", "solar_mw", "hydro_mw")
    base_source: str = "nuclear_mw"
    low: float = LOAD_MIN
    high: float = LOAD_MAX
    fill: tuple[str, ...] = FILLED_COLUMNS
    score: tuple[str, ...] = SCORE_COLUMNS
    keys: tuple[str, ...] = ()
    cadence: int | None = 30 * MINUTE  # the least step between rows of a key, None where unknown: rows are counted then


def source_priority(df: DataFrame) -> list[str | Column]:
    """Which copy of a reading wins: settled before provisional data, then the newest ingest, then file order."""
    order: list[str | Column] = []
    if "nature" in df.columns:
        settled = F.lower("nature").contains("définitiv")
        order.append(F.when(settled, 0).when(F.lower("nature").contains("consolid"), 1).otherwise(2))
    if "ingested_at" in df.columns:
        order.append(-F.unix_micros(F.col("ingested_at").try_cast("timestamp")))
    return [*order, *available(df, ["source_file"]), *[c for c in df.columns if c not in ("source_file", "nature", "ingested_at")]]


def clean(df: DataFrame, spec: SeriesSpec = SeriesSpec(), priority: Sequence[str | Column] | None = None,
          cut: bool = False) -> DataFrame:
    """Timed rows only, one per key and time, load in range or missing, numbers typed, flagged and filled.

    Filling reads the de-duplicated rows twice. `cut` writes them once to the checkpoint folder
    instead of computing them again; worth it when `df` is dear to compute.
    """
    timed = require_not_null(df, spec.time)
    keys = [*spec.keys, spec.time]
    rest = [o for o in (priority or source_priority(timed)) if not (isinstance(o, str) and o in keys)]
    single = keep_first(timed, keys, rest or keys)
    if cut:
        single = materialize(single)
    typed = cast_numeric(single, MEASURE_COLUMNS)
    ranged = range_filter_nullable(typed, {spec.load: (spec.low, spec.high)})
    scored = available(ranged, spec.score)
    flagged = ranged.select("*", F.col(spec.load).isNull().alias("is_interpolated"),
                            completeness(scored).alias("completeness_before"))
    return fill_gaps(flagged, spec.time, available(flagged, spec.fill), spec.keys, F.year(spec.time), cadence=spec.cadence)


def derive(df: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """Columns that need nothing but their own row: calendar, cyclic, share, error, score."""
    parts = calendar_parts(spec.time)
    sin, cos = cyclic(parts["hour"], 24)
    have = set(df.columns)
    new: dict[str, Column] = {
        **parts, "season": season(spec.time), "is_weekend": is_weekend(spec.time),
        "is_peak_hour": is_peak_hour(spec.time), "hour_sin": sin, "hour_cos": cos,
        "renewable_share_pct": share_pct(available(df, spec.renewables), spec.load),
        "quality_score": completeness(available(df, spec.score)),
    }
    if spec.base_source in have:
        new["nuclear_share_pct"] = plain_share_pct(spec.base_source, spec.load)
    if spec.forecast in have:
        new["forecast_error_mw"] = forecast_error(spec.load, spec.forecast)
        new["forecast_error_pct"] = forecast_error_pct(spec.load, spec.forecast)
    return df.select(*[c for c in df.columns if c not in new], *[e.alias(n) for n, e in new.items()])


def look_back(df: DataFrame, spec: SeriesSpec = SeriesSpec(), by_time: bool = True,
              exclude_current: bool = False) -> DataFrame:
    """Lag and rolling columns.

    They are by time and cross year ends; with `by_time` off they count rows inside a year
    (2, 48 and 336 rows; 49 rows with the current one). `exclude_current` keeps the value being
    predicted out of the rolling columns.
    """
    keep = not exclude_current
    if by_time:
        return time_windows(df, spec.time, {
            "lag_1h_mw": Lag(spec.load, HOUR), "lag_24h_mw": Lag(spec.load, 24 * HOUR),
            "lag_168h_mw": Lag(spec.load, 168 * HOUR),
            "rolling_24h_mean": Rolling(spec.load, 24 * HOUR, "mean", include_current=keep),
            "rolling_24h_std": Rolling(spec.load, 24 * HOUR, "std", include_current=keep)}, spec.keys, cadence=spec.cadence)
    return row_windows(df, spec.time, {
        "lag_1h_mw": Lag(spec.load, 2), "lag_24h_mw": Lag(spec.load, 48), "lag_168h_mw": Lag(spec.load, 336),
        "rolling_24h_mean": Rolling(spec.load, 48, "mean", include_current=keep),
        "rolling_24h_std": Rolling(spec.load, 48, "std", include_current=keep)}, spec.keys, F.year(spec.time), cadence=spec.cadence)


def engineer(df: DataFrame, spec: SeriesSpec = SeriesSpec(), by_time: bool = True,
             exclude_current: bool = False) -> DataFrame:
    """All features. The look-back shuffle carries the input columns only; the rest follows after it."""
    return derive(look_back(df, spec, by_time, exclude_current), spec)


def silver(raw: DataFrame, spec: SeriesSpec = SeriesSpec(), by_time: bool = True,
           columns: Sequence[str] | None = SILVER_COLUMNS, cut: bool = False) -> DataFrame:
    out = engineer(clean(raw, spec, cut=cut), spec, by_time)
    return available_columns(out, [*spec.keys, *columns]) if columns else out


def gold(clean_rows: DataFrame, spec: DailySpec = DailySpec(), adjacent_only: bool = True) -> tuple[DataFrame, DataFrame]:
    daily = daily_rollup(clean_rows, spec)
    return daily, monthly_rollup(daily, adjacent_only)


def with_source_energy(monthly: DataFrame, clean_rows: DataFrame, spec: SeriesSpec = SeriesSpec(),
                       cadence_hours: float = 0.5) -> DataFrame:
    """The monthly table with the energy of each source in GWh."""
    sources = available(clean_rows, [spec.base_source, *spec.renewables])
    names = {f"{c.removesuffix('_mw')}_total_gwh": c for c in sources}
    energy = source_energy_by_month(clean_rows, spec.time, names, cadence_hours)
    return monthly.join(energy, ["year", "month"], "left")
