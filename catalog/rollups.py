"""Daily, monthly and annual roll-ups, peaks, mixes, and the clean layer they start from."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.functions.calendar import is_peak_hour
from loadtide.functions.measures import mean_of
from loadtide.functions.timeaxis import HOUR
from loadtide.operators import impute, rollup, select
from loadtide.operators.rollup import DailySpec
from loadtide.plans import layers
from loadtide.plans.layers import SeriesSpec
from loadtide.sources.scratch import materialize

from .base import DEC, O0, S0, SLOT, U0, events, mix, orders, query, table, user_series

PROFILE = DailySpec(time="b30", load="load", sources={"error_filled": "error"}, exchanges=None, imputed="error_was_null")


@query("daily_profile", f"""
    WITH {S0}, f AS (SELECT *, coalesce(error, last_value(error IGNORE NULLS) OVER (PARTITION BY year(b30) ORDER BY b30 ROWS UNBOUNDED PRECEDING),
        first_value(error IGNORE NULLS) OVER (PARTITION BY year(b30) ORDER BY b30 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS e FROM s0)
    SELECT CAST(b30 AS DATE) AS day, avg(load) AS mean, avg(e) AS error_filled, min(load) AS min, max(load) AS max, stddev_samp(load) AS std,
        sum(load) * 0.5 / 1000 AS energy, count(*) AS n, count(*) FILTER (error IS NULL) AS imputed,
        hour(arg_min(b30, (-load, b30))) AS peak_hour, max(load) AS peak_value FROM f GROUP BY 1""",
       doubles="mean min max std energy:10 peak_value error_filled")
def _(spark, sf):
    """Flagship: raw events to half-hour mix, flagged and filled, then one row per day with its peak."""
    s = impute.flag_missing(mix(spark, sf), ["error"])
    filled = impute.fill_gaps(s, "b30", ["error"], period=F.year("b30"), cadence=SLOT)
    return rollup.daily_rollup(filled, PROFILE).select(
        F.col("date").alias("day"), F.col("consumption_mean_mw").alias("mean"), F.col("consumption_min_mw").alias("min"),
        F.col("consumption_max_mw").alias("max"), F.col("consumption_std_mw").alias("std"),
        F.col("consumption_total_gwh").alias("energy"), F.col("records_count").alias("n"),
        F.col("interpolated_count").alias("imputed"), "error_filled", "peak_hour", F.col("peak_consumption_mw").alias("peak_value"))


@query("daily_rollup", """
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year, month(o_orderdate) AS month,
        count(*) AS records_count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS consumption_mean_mw,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) * 0.5 / 1000 AS consumption_total_gwh,
        max(o_totalprice) AS peak_consumption_mw FROM orders GROUP BY ALL""",
       doubles="consumption_mean_mw consumption_total_gwh peak_consumption_mw")
def _(spark, sf):
    """Keyed form: one row per customer and day."""
    spec = DailySpec(time="o_orderdate", load="o_totalprice", sources={}, exchanges=None, keys=("o_custkey",))
    return rollup.daily_rollup(orders(spark, sf).drop("year", "month"), spec).select(
        "o_custkey", "date", "year", "month", "records_count", "consumption_mean_mw", "consumption_total_gwh",
        "peak_consumption_mw")


@query("daily_peak", f"""
    WITH {U0} SELECT user_id, CAST(b30 AS DATE) AS date, hour(arg_min(b30, (-load, b30))) AS peak_hour, max(load) AS peak_value
    FROM u0 GROUP BY 1, 2""", doubles="peak_value")
def _(spark, sf):
    """Peak hour and value of every user and day; the earliest time wins a tie."""
    return rollup.daily_peak(user_series(spark, sf), "b30", "load", ["user_id"])


@query("rank_peak", """
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS peak_value FROM orders GROUP BY 1, 2""")
def _(spark, sf):
    return rollup.daily_peak(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", ["o_custkey"]).drop("peak_hour")


@query("left_join_peak", f"""
    WITH {S0}, d AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1),
    p AS (SELECT CAST(b30 AS DATE) AS date, hour(arg_min(b30, (-error, b30))) AS peak_hour, max(error) AS peak_value
          FROM s0 WHERE error IS NOT NULL GROUP BY 1)
    SELECT d.date, n, peak_hour, peak_value FROM d LEFT JOIN p USING (date)""", doubles="peak_value")
def _(spark, sf):
    days = rollup.rows_per_day(events(spark, sf), "ts")
    peaks = rollup.daily_peak(mix(spark, sf).filter("error IS NOT NULL"), "b30", "error")
    return rollup.left_join_peak(days, peaks)


@query("monthly_rollup", f"""
    WITH {O0}, d AS (SELECT yr, mon, CAST(o_orderdate AS DATE) AS dt, CAST(sum(price) AS DOUBLE) / count(*) AS m,
                     CAST(sum(price) AS DOUBLE) * 0.5 / 1000 AS gwh FROM o0 GROUP BY ALL),
    s AS (SELECT yr AS year, mon AS month, avg(m) AS consumption_mean_mw, sum(gwh) / 1000 AS consumption_total_twh,
          count(*) AS trading_days FROM d GROUP BY 1, 2)
    SELECT year, month, CASE WHEN month IN (12, 1, 2) THEN 0 WHEN month IN (3, 4, 5) THEN 1 WHEN month IN (6, 7, 8) THEN 2 ELSE 3 END
        AS season, consumption_mean_mw, consumption_total_twh, trading_days, CASE WHEN lag(year) OVER w = year - 1
        THEN (consumption_total_twh / lag(consumption_total_twh) OVER w - 1) * 100 END AS consumption_yoy_pct
    FROM s WINDOW w AS (PARTITION BY month ORDER BY year)""",
       doubles="consumption_mean_mw:5 consumption_total_twh:9 consumption_yoy_pct", ints="season")
def _(spark, sf):
    daily, monthly = layers.gold(orders(spark, sf).drop("year", "month"),
                                 DailySpec(time="o_orderdate", load="o_totalprice", sources={}, exchanges=None))
    return monthly


_YOY = f"""
    WITH {O0}, s AS (SELECT yr + (yr >= 1998)::INT AS year, mon AS month, CAST(sum(price) AS DOUBLE) AS total, count(*) AS days
                     FROM o0 GROUP BY 1, 2)
    SELECT year, month, total, days, {{}} AS yoy_pct FROM s WINDOW w AS (PARTITION BY month ORDER BY year)"""
_CHANGE = "(total - lag(total) OVER w) / lag(total) OVER w * 100"


def _month_totals(spark, sf):
    """Monthly totals of all orders; the years from 1998 on are moved by one, so that a year is missing."""
    moved = orders(spark, sf).withColumn("year", F.col("year") + (F.col("year") >= 1998).cast("int"))
    return moved.groupBy("year", "month").agg(
        F.sum("o_totalprice").cast("double").alias("total"), F.count(F.lit(1)).alias("days"))


@query("monthly_yoy", _YOY.format(f"CASE WHEN lag(year) OVER w = year - 1 THEN {_CHANGE} END"), doubles="total yoy_pct")
def _(spark, sf):
    """Change on the year before; the year after a missing one has none."""
    return rollup.year_on_year(_month_totals(spark, sf), "total", name="yoy_pct")


@query("lag_period_change", _YOY.format(_CHANGE), doubles="total yoy_pct")
def _(spark, sf):
    """Change on the previous row of the month, whatever its year."""
    return rollup.year_on_year(_month_totals(spark, sf), "total", name="yoy_pct", adjacent_only=False)


@query("annual_full_outer", """
    WITH a AS (SELECT year(o_orderdate) AS y, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_total FROM orders GROUP BY 1),
    b AS (SELECT year(l_shipdate) + 2 AS y, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS ship_total FROM lineitem GROUP BY 1)
    SELECT coalesce(a.y, b.y) AS year, order_total, ship_total FROM a FULL OUTER JOIN b ON a.y = b.y""",
       doubles="order_total ship_total")
def _(spark, sf):
    """Yearly totals of two tables, the second one's years moved by two; a year that only one has stays."""
    lines = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate") + 2)
    return rollup.annual_summary(
        orders(spark, sf), lines,
        {"order_total": F.sum("o_totalprice").cast("double")},
        {"ship_total": F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")})


_ANNUAL = f"""
    {O0}, d AS (SELECT yr, mon, CAST(o_orderdate AS DATE) AS dt, CAST(sum(price) AS DOUBLE) * 0.5 / 1000 AS gwh FROM o0 GROUP BY ALL),
    y AS (SELECT yr AS year, sum(gwh) / 1000 AS consumption_twh, count(*) AS days FROM d GROUP BY 1),
    m AS (SELECT yr AS year, count(DISTINCT mon) AS months FROM d GROUP BY 1)"""


def _annual(spark, sf):
    daily, monthly = layers.gold(orders(spark, sf).drop("year", "month"),
                                 DailySpec(time="o_orderdate", load="o_totalprice", sources={}, exchanges=None))
    return rollup.annual_summary(
        daily, monthly, {"consumption_twh": F.sum("consumption_total_gwh") / 1000, "days": F.count(F.lit(1))},
        {"months": F.count(F.lit(1))})


@query("annual_summary", f"WITH {_ANNUAL} SELECT year, consumption_twh, days, months FROM y FULL JOIN m USING (year)",
       doubles="consumption_twh")
def _(spark, sf):
    return _annual(spark, sf)


@query("annual_energy", f"WITH {_ANNUAL} SELECT year, round(consumption_twh, 2) AS consumption_twh FROM y ORDER BY year",
       doubles="consumption_twh", digits=2)
def _(spark, sf):
    return rollup.annual_energy(_annual(spark, sf).select("year", "consumption_twh"))


@query("off_peak_mean", f"""
    WITH {S0} SELECT CAST(b30 AS DATE) AS date, avg(load) FILTER (NOT (hour(b30) BETWEEN 8 AND 20 AND dayofweek(b30) NOT IN (0, 6)))
        AS off_peak_mean FROM s0 GROUP BY 1""", doubles="off_peak_mean")
def _(spark, sf):
    return mix(spark, sf).groupBy(F.to_date("b30").alias("date")).agg(
        rollup.off_peak_mean("load", is_peak_hour("b30")).alias("off_peak_mean"))


@query("net_export_gwh", f"""
    SELECT CAST(ts AS DATE) AS date, -CAST(sum(CASE event_type WHEN 'purchase' THEN -{DEC} WHEN 'error' THEN {DEC} END) AS DOUBLE)
        * 0.5 / 1000 AS net_export FROM events GROUP BY 1""", doubles="net_export")
def _(spark, sf):
    """Signed exchanges (purchases leave, errors come in) as a daily export."""
    t = F.col("event_type")
    signed = F.when(t == "purchase", -F.col("value")).when(t == "error", F.col("value"))
    return events(spark, sf).withColumn("x", signed).groupBy(F.to_date("ts").alias("date")).agg(
        rollup.net_export_gwh("x", 0.5).alias("net_export"))


@query("source_energy_by_month", f"""
    SELECT year(ts) AS year, month(ts) AS month, CAST(sum({DEC}) FILTER (event_type = 'view') AS DOUBLE) * 0.5 / 1000 AS wind_gwh,
        CAST(sum({DEC}) FILTER (event_type = 'click') AS DOUBLE) * 0.5 / 1000 AS solar_gwh FROM events GROUP BY 1, 2""",
       doubles="wind_gwh solar_gwh")
def _(spark, sf):
    e = events(spark, sf).select("ts", *[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in ("view", "click")])
    return rollup.source_energy_by_month(e, "ts", {"wind_gwh": "view", "solar_gwh": "click"})


_MIX30 = " UNION ALL ".join(
    f"SELECT '{t}' AS metric, CAST(sum({DEC}) AS DOUBLE) / count(*) AS value FROM events "
    f"WHERE event_type = '{t}' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 20 DAY" for t in ("purchase", "view", "click", "signup"))


@query("mix_by_source", _MIX30, doubles="value")
def _(spark, sf):
    """Mean of each source over the last 20 days of the data."""
    recent = select.trailing_window(events(spark, sf), "ts", 20)
    wide = recent.select(*[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in ("purchase", "view", "click", "signup")])
    return rollup.mix_by_source(wide, {t: t for t in ("purchase", "view", "click", "signup")}, digits=None)


@query("trailing_30d_mix", _MIX30.replace("20 DAY", "30 DAY"), doubles="value")
def _(spark, sf):
    recent = select.trailing_window(events(spark, sf), "ts", 30)
    wide = recent.select(*[F.when(F.col("event_type") == t, F.col("value")).alias(t) for t in ("purchase", "view", "click", "signup")])
    return rollup.mix_by_source(wide, {t: t for t in ("purchase", "view", "click", "signup")}, digits=None)


@query("union_all", """
    SELECT o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT l_returnflag, count(*) FROM lineitem GROUP BY 1 UNION ALL SELECT event_type, count(*) FROM events GROUP BY 1""")
def _(spark, sf):
    parts = (("orders", "o_orderstatus"), ("lineitem", "l_returnflag"), ("events", "event_type"))
    a, b, c = (table(spark, sf, t).groupBy(F.col(k).alias("kind")).agg(F.count(F.lit(1)).alias("n")) for t, k in parts)
    return a.unionAll(b).unionAll(c)


@query("layer_counts", f"""
    SELECT 'raw' AS layer, count(*) AS n FROM events UNION ALL SELECT 'clean', count(DISTINCT time_bucket(INTERVAL 30 MINUTE, ts)) FROM events
    UNION ALL SELECT 'daily', count(DISTINCT CAST(ts AS DATE)) FROM events""")
def _(spark, sf):
    s = mix(spark, sf)
    return rollup.layer_counts({"raw": events(spark, sf), "clean": s, "daily": rollup.rows_per_day(s, "b30")})


@query("rows_per_day", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return rollup.rows_per_day(table(spark, sf, "orders"), "o_orderdate")


# The clean layer on the half-hour mix: total as load, event types as sources.
SERIES = SeriesSpec(low=200.0, high=1200.0)


def national(spark, sf):
    """The mix under the column names of a load table; the load is missing where there were no purchases.

    The series is computed once: cleaning reads it twice, and it is far smaller than the events.
    """
    s = materialize(mix(spark, sf))
    load = F.when(F.col("purchase").isNotNull(), F.col("load") * 6)
    return s.select(F.col("b30").alias("datetime"), load.alias("consumption_mw"), F.col("purchase").alias("nuclear_mw"),
                    F.col("view").alias("wind_mw"), F.col("click").alias("solar_mw"), F.col("signup").alias("hydro_mw"),
                    F.col("error").alias("co2_rate"), (F.col("load") * 5 + F.col("view") / 10).alias("forecast_j1_mw"))


def _fill(c):
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY year(datetime) ORDER BY datetime ROWS UNBOUNDED PRECEDING), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY year(datetime) ORDER BY datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


CLEAN_SQL = f"""{S0}, raw AS (SELECT b30 AS datetime, CASE WHEN purchase IS NOT NULL THEN load * 6 END AS consumption_mw, purchase AS nuclear_mw,
        view AS wind_mw, click AS solar_mw, signup AS hydro_mw, error AS co2_rate, load * 5 + view / 10 AS forecast_j1_mw FROM s0),
    kept AS (SELECT *, consumption_mw IS NULL AS is_interpolated FROM raw WHERE consumption_mw IS NULL OR consumption_mw BETWEEN 200 AND 1200),
    clean AS (SELECT datetime, {_fill('consumption_mw')}, {_fill('nuclear_mw')}, {_fill('wind_mw')}, {_fill('solar_mw')},
        hydro_mw, co2_rate, forecast_j1_mw, is_interpolated FROM kept)"""
FEATURE_SQL = f"""{CLEAN_SQL}, feat AS (SELECT *, consumption_mw - forecast_j1_mw AS forecast_error_mw,
        CASE WHEN consumption_mw > 0 THEN abs(consumption_mw - forecast_j1_mw) / consumption_mw * 100 END AS forecast_error_pct,
        CASE WHEN consumption_mw > 0 THEN (coalesce(wind_mw, 0) + coalesce(solar_mw, 0) + coalesce(hydro_mw, 0)) / consumption_mw * 100 END
            AS renewable_share_pct, CASE WHEN consumption_mw > 0 THEN nuclear_mw / consumption_mw * 100 END AS nuclear_share_pct,
        ((consumption_mw IS NOT NULL)::INT + (nuclear_mw IS NOT NULL)::INT + (wind_mw IS NOT NULL)::INT + (solar_mw IS NOT NULL)::INT
            + (co2_rate IS NOT NULL)::INT) / 5 AS quality_score FROM clean)"""
_SILVER = ["datetime", "consumption_mw", "forecast_error_mw", "forecast_error_pct", "nuclear_mw", "wind_mw", "solar_mw", "co2_rate",
           "lag_1h_mw", "lag_24h_mw", "lag_168h_mw", "rolling_24h_mean", "rolling_24h_std", "renewable_share_pct",
           "nuclear_share_pct", "is_interpolated", "quality_score"]
_SILVER_NUM = " ".join(c for c in _SILVER if c not in ("datetime", "is_interpolated"))
_SILVER_SQL = ("SELECT datetime, consumption_mw, forecast_error_mw, forecast_error_pct, nuclear_mw, wind_mw, solar_mw, co2_rate, "
               "{lags}, renewable_share_pct, nuclear_share_pct, is_interpolated, quality_score FROM feat {tail}")
_BY_ROWS = _SILVER_SQL.format(
    lags="lag(consumption_mw, 2) OVER w AS lag_1h_mw, lag(consumption_mw, 48) OVER w AS lag_24h_mw, lag(consumption_mw, 336) OVER w "
         "AS lag_168h_mw, avg(consumption_mw) OVER f AS rolling_24h_mean, stddev_samp(consumption_mw) OVER f AS rolling_24h_std",
    tail="WINDOW w AS (PARTITION BY year(datetime) ORDER BY datetime), "
         "f AS (PARTITION BY year(datetime) ORDER BY datetime ROWS BETWEEN 48 PRECEDING AND CURRENT ROW)")
_AT = "(SELECT consumption_mw FROM clean p WHERE p.datetime = feat.datetime - INTERVAL {} HOUR) AS {}"
_BY_TIME = _SILVER_SQL.format(
    lags=", ".join([_AT.format(1, "lag_1h_mw"), _AT.format(24, "lag_24h_mw"), _AT.format(168, "lag_168h_mw"),
                    "avg(consumption_mw) OVER f AS rolling_24h_mean", "stddev_samp(consumption_mw) OVER f AS rolling_24h_std"]),
    tail="WINDOW f AS (ORDER BY datetime RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW)")


@query("silver_by_time", f"WITH {FEATURE_SQL} {_BY_TIME}", doubles=_SILVER_NUM, digits=7)
def _(spark, sf):
    """Raw to clean table with all features; lags and rolling columns by time."""
    return layers.silver(national(spark, sf), SERIES, columns=_SILVER)


@query("silver_by_rows", f"WITH {FEATURE_SQL} {_BY_ROWS}", doubles=_SILVER_NUM, digits=7)
def _(spark, sf):
    """The same with lags and rolling columns by rows inside the year."""
    return layers.silver(national(spark, sf), SERIES, by_time=False, columns=_SILVER)


_GOLD_SQL = f"""WITH {FEATURE_SQL} SELECT CAST(datetime AS DATE) AS date, year(datetime) AS year, month(datetime) AS month,
        dayofweek(datetime) + 1 AS day_of_week, CASE WHEN month(datetime) IN (12, 1, 2) THEN 0 WHEN month(datetime) IN (3, 4, 5) THEN 1
        WHEN month(datetime) IN (6, 7, 8) THEN 2 ELSE 3 END AS season, dayofweek(datetime) IN (0, 6) AS is_weekend,
        avg(consumption_mw) AS consumption_mean_mw, min(consumption_mw) AS consumption_min_mw, max(consumption_mw) AS consumption_max_mw,
        stddev_samp(consumption_mw) AS consumption_std_mw, sum(consumption_mw) * 0.5 / 1000 AS consumption_total_gwh,
        avg(forecast_error_pct) AS forecast_mape_pct, avg(abs(forecast_error_mw)) AS forecast_mae_mw,
        avg(nuclear_mw) AS nuclear_mean_mw, avg(wind_mw) AS wind_mean_mw, avg(solar_mw) AS solar_mean_mw, avg(hydro_mw) AS hydro_mean_mw,
        avg(renewable_share_pct) AS renewable_share_pct, avg(nuclear_share_pct) AS nuclear_share_pct,
        avg(co2_rate) AS co2_mean_gkwh, min(co2_rate) AS co2_min_gkwh, max(co2_rate) AS co2_max_gkwh, count(*) AS records_count,
        count(*) FILTER (is_interpolated) AS interpolated_count, avg(quality_score) AS quality_score_mean,
        hour(arg_min(datetime, (-consumption_mw, datetime))) AS peak_hour, max(consumption_mw) AS peak_consumption_mw
    FROM feat GROUP BY 1, 2, 3, 4, 5, 6"""


@query("gold_daily", _GOLD_SQL, ints="season", digits=7, doubles="""consumption_mean_mw consumption_min_mw consumption_max_mw
    consumption_std_mw consumption_total_gwh forecast_mape_pct forecast_mae_mw nuclear_mean_mw wind_mean_mw solar_mean_mw
    hydro_mean_mw renewable_share_pct nuclear_share_pct co2_mean_gkwh co2_min_gkwh co2_max_gkwh quality_score_mean peak_consumption_mw""")
def _(spark, sf):
    """Clean table to the 27 daily columns."""
    daily, _ = layers.gold(layers.silver(national(spark, sf), SERIES))
    return daily.drop("off_peak_mean_mw")
