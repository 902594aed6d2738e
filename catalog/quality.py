"""Check catalogues, gaps, verdicts and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from loadtide.operators import quality
from loadtide.plans import layers

from .base import orders, query, table
from .rollups import CLEAN_SQL, FEATURE_SQL, SERIES, national

_ROW = ("SELECT '{name}' AS check_name, '{table}' AS table_name, '{sev}' AS severity, '{op}' AS operator, {thr}::DOUBLE AS threshold, "
        "v::DOUBLE AS value, coalesce(v {op} {thr}, false) AS passed, CASE WHEN v IS NULL THEN 'no_data' WHEN v {op} {thr} THEN 'pass' "
        "ELSE '{sev}' END AS status, '{detail}' AS detail FROM (SELECT {metric} AS v FROM {src})")


def _rows(src, name, *checks):
    return " UNION ALL ".join(_ROW.format(name=n, table=name, sev=s, op=o, thr=t, metric=m, src=src, detail=d)
                              for n, m, o, t, s, d in checks)


_F = f"WITH {FEATURE_SQL}, f AS (SELECT *, year(datetime) AS year FROM feat)"
_GAP = "max(year) - min(year) + 1 - count(DISTINCT year)"
_POST = _rows("f", "silver",
              ("silver_row_count", "count(*)", ">=", 1000, "critical", ""),
              ("null_consumption_rate", "count(*) FILTER (consumption_mw IS NULL) / count(*)", "<=", 0.05, "critical", ""),
              ("avg_quality_score", "avg(quality_score)", ">=", 0.75, "warning", ""),
              ("year_coverage_gaps", _GAP, "<=", 0, "critical", "No year missing between the first and the last"))
_POST_DAILY = _rows("(SELECT DISTINCT CAST(ts AS DATE) FROM events)", "daily", ("gold_daily_count", "count(*)", ">=", 30, "critical", ""))


def _silver(series):
    return layers.derive(layers.clean(series, SERIES), SERIES)


def _days(series):
    return series.select(F.to_date("datetime").alias("date")).distinct()


def post(spark, sf):
    series = national(spark, sf)
    return quality.union_results(
        quality.run_checks(_silver(series), quality.post_load_checks(), "silver"),
        quality.run_checks(_days(series), quality.post_load_daily_checks(), "daily"))


@query("quality_post", f"{_F} {_POST} UNION ALL {_POST_DAILY}", doubles="value")
def _(spark, sf):
    return post(spark, sf)


_MON = _rows("f", "silver",
             ("silver_volume_total", "count(*)", ">=", 10000, "critical", ""),
             ("score_qualite_global", "avg(quality_score)", ">=", 0.6, "warning", ""),
             ("taux_null_consommation", "count(*) FILTER (consumption_mw IS NULL) / count(*)", "<=", 0.3, "warning", ""),
             ("plage_consommation_global", "count(*) FILTER (consumption_mw NOT BETWEEN 100 AND 1500) / count(consumption_mw)",
              "<=", 0.01, "warning", ""),
             ("annees_distinctes", "count(DISTINCT year)", ">=", 1, "critical", ""),
             ("coherence_nucleaire", "avg(nuclear_mw)", ">=", 100, "warning", ""))
_MON += " UNION ALL " + _rows("(SELECT DISTINCT CAST(ts AS DATE) FROM events)", "daily",
                              ("agg_daily_calcules", "count(*)", ">=", 100, "critical", ""))
_MON += " UNION ALL " + _rows("(SELECT DISTINCT year(ts), month(ts) FROM events)", "monthly",
                              ("agg_monthly_calcules", "count(*)", ">=", 1, "warning", ""))
_MON += " UNION ALL " + _rows(
    "(SELECT count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01' GROUP BY l_orderkey, l_linenumber)", "lines",
    ("doublons_recents", "count(*) FILTER (n > 1)", "<=", 0, "warning", ""))
_MON += " UNION ALL " + _rows("orders", "runs", ("pipeline_runs_enregistres", "count(*)", ">=", 1, "warning", ""))


def monitoring(spark, sf):
    recent = quality.rows_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                                  F.col("l_shipdate") >= F.lit("2001-06-01").cast("timestamp"))
    series = national(spark, sf)
    months = series.select(F.year("datetime").alias("y"), F.month("datetime").alias("m")).distinct()
    return quality.union_results(
        quality.run_checks(_silver(series), quality.monitoring_checks(low=100, high=1500, min_base=100), "silver"),
        quality.run_checks(_days(series), quality.monitoring_daily_checks(), "daily"),
        quality.run_checks(months, quality.monitoring_monthly_checks(), "monthly"),
        quality.run_checks(recent, quality.recent_duplicate_checks(), "lines"),
        quality.run_checks(table(spark, sf, "orders"), quality.monitoring_run_checks(), "runs"))


@query("quality_monitoring", f"{_F} {_MON}", doubles="value")
def _(spark, sf):
    return monitoring(spark, sf)


def _day_sql(day, name):
    src = f"(SELECT * FROM f WHERE CAST(datetime AS DATE) = DATE '{day}')"
    return _rows(src, name,
                 ("completude_24h", "count(*)", ">=", 40, "warning", ""),
                 ("null_consumption", "count(*) FILTER (consumption_mw IS NULL) / nullif(count(*), 0)", "<=", 0.05, "warning", ""),
                 ("avg_quality_score", "avg(quality_score)", ">=", 0.75, "warning", ""))


@query("quality_daily", f"{_F} {_day_sql('2024-01-15', 'full day')} UNION ALL {_day_sql('2025-06-01', 'empty day')}", doubles="value")
def _(spark, sf):
    """Day checks on a day with data and on one without (no data is neither a pass nor a zero)."""
    s = _silver(national(spark, sf))
    return quality.union_results(*[
        quality.run_checks(quality.on_day(s, "datetime", d), quality.daily_stream_checks(), n)
        for d, n in ((date(2024, 1, 15), "full day"), (date(2025, 6, 1), "empty day"))])


@query("run_checks", """
    SELECT 'rows' AS check_name, 'orders' AS table_name, 'critical' AS severity, '>=' AS operator, 1.0::DOUBLE AS threshold,
        count(*)::DOUBLE AS value, true AS passed, 'pass' AS status, '' AS detail FROM orders
    UNION ALL SELECT 'price_range', 'orders', 'warning', '<=', 0.2, count(*) FILTER (o_totalprice NOT BETWEEN 100000 AND 400000) / count(*),
        count(*) FILTER (o_totalprice NOT BETWEEN 100000 AND 400000) / count(*) <= 0.2,
        CASE WHEN count(*) FILTER (o_totalprice NOT BETWEEN 100000 AND 400000) / count(*) <= 0.2 THEN 'pass' ELSE 'warning' END, '' FROM orders
    UNION ALL SELECT 'no_such_column', 'orders', 'warning', '<=', 0.0, NULL, false, 'error', 'UNRESOLVED_COLUMN.WITH_SUGGESTION'""",
       doubles="value threshold")
def _(spark, sf):
    """Fused checks of one table; one of them names a column that is not there."""
    checks = [quality.Check("rows", lambda: F.count(F.lit(1)), ">=", 1, "critical"),
              quality.Check("price_range", lambda: quality.out_of_range_rate("o_totalprice", 100000, 400000), "<=", 0.2),
              quality.Check("no_such_column", lambda: quality.null_rate("tide"), "<=", 0)]
    return quality.run_checks(table(spark, sf, "orders"), checks, "orders")


_V = """SELECT count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (passed) * 100.0::DOUBLE / count(*) AS score_pct,
    coalesce(string_agg(check_name, ', ' ORDER BY check_name) FILTER (NOT passed AND severity = 'critical'), '') AS failed_critical,
    coalesce(string_agg(check_name, ', ' ORDER BY check_name) FILTER (NOT passed AND severity <> 'critical'), '') AS failed_warning,
    bool_and(passed) AS all_passed FROM r"""


@query("quality_verdict", f"{_F}, r AS ({_MON}) {_V}", doubles="score_pct")
def _(spark, sf):
    return quality.verdict(monitoring(spark, sf))


@query("quality_report", f"""
    {_F}, r AS ({_POST} UNION ALL {_POST_DAILY})
    SELECT check_name, round(value, 4) AS actual_value, CASE WHEN passed THEN 'PASS' WHEN severity = 'critical' THEN 'CRITICAL'
        ELSE 'WARNING' END AS result FROM r""", doubles="actual_value", digits=4)
def _(spark, sf):
    return quality.quality_report(post(spark, sf)).drop("limit")


@query("run_status", f"""
    {_F}, r AS ({_MON}), v AS ({_V}) SELECT failed_critical, CASE WHEN failed_critical <> '' THEN 'failed'
        WHEN failed_warning <> '' THEN 'success_with_warnings' ELSE 'success' END AS status FROM v""")
def _(spark, sf):
    return quality.run_status(quality.verdict(monitoring(spark, sf)), F.lit(False)).select("failed_critical", "status")


@query("year_gaps", """
    WITH y AS (SELECT DISTINCT 2 * year(l_shipdate) - 1990 AS y FROM lineitem)
    SELECT r AS year FROM range(1980, 2040) t(r) WHERE r > (SELECT min(y) FROM y) AND r < (SELECT max(y) FROM y) AND r NOT IN (SELECT y FROM y)""")
def _(spark, sf):
    """Every second year is missing once the years are drawn apart."""
    apart = table(spark, sf, "lineitem").select(F.make_date(2 * F.year("l_shipdate") - 1990, F.lit(1), F.lit(1)).alias("day"))
    return quality.year_gaps(apart, "day")


@query("year_gaps_by_customer", """
    WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate)::BIGINT AS y FROM orders),
    b AS (SELECT o_custkey, min(y) AS lo, max(y) AS hi FROM y GROUP BY 1)
    SELECT o_custkey, r AS missing FROM b, range(1990, 2010) t(r) WHERE r > lo AND r < hi
    AND NOT EXISTS (SELECT 1 FROM y WHERE y.o_custkey = b.o_custkey AND y.y = r)""")
def _(spark, sf):
    """Years without an order between each customer's first and last."""
    return quality.integer_gaps(orders(spark, sf), "year", ["o_custkey"])


@query("source_inventory", """
    SELECT l_returnflag AS source_file, count(*) AS n_rows, min(l_shipdate) AS min_time, max(l_shipdate) AS max_time,
        array_to_string(list_sort(list_distinct(list(year(l_shipdate)))), ',') AS years FROM lineitem GROUP BY 1""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "source_file")
    return quality.source_inventory(rows, time="l_shipdate")


@query("source_verdict", """
    WITH o AS (SELECT list_sort(list_distinct(list(year(o_orderdate) + (year(o_orderdate) >= 1997)::INT))) AS a FROM orders),
    c AS (SELECT list_sort(list_distinct(list(year(l_shipdate)))) AS a FROM lineitem),
    g AS (SELECT o.a AS o, c.a AS c, list_filter(range(list_min(o.a), list_max(o.a) + 1), lambda y: NOT list_contains(o.a, y)) AS gaps FROM o, c)
    SELECT array_to_string(o, ',') AS years_covered, array_to_string(gaps, ',') AS year_gaps,
        array_to_string(list_filter(c, lambda y: NOT list_contains(o, y)), ',') AS calendar_only_years, len(o) > 0 AND len(gaps) = 0 AS passed FROM g""")
def _(spark, sf):
    """Orders, those from 1997 on moved by a year, against the shipping calendar that has the year between."""
    moved = F.add_months("o_orderdate", F.when(F.col("year") >= 1997, 12).otherwise(0))
    return quality.source_verdict(orders(spark, sf).withColumn("o_orderdate", moved),
                                  table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "date"), "o_orderdate")


@query("ml_ready_count", f"""
    WITH {CLEAN_SQL} SELECT count(*) AS ready_rows, count(*) >= 1000 AS ready FROM clean WHERE consumption_mw IS NOT NULL AND co2_rate IS NOT NULL""")
def _(spark, sf):
    return quality.ml_ready(layers.clean(national(spark, sf), SERIES), ["consumption_mw", "co2_rate"])
