"""Raw against clean data, profiles, histograms, densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.functions.timeaxis import MINUTE
from loadtide.operators import compare, profile
from loadtide.operators.impute import fill_gaps
from loadtide.sources.scratch import materialize

from .base import B30, DEC, O0, S0, TYPES, events, mix, orders, query, table

LOW, HIGH = 20.0, 300.0


def raw_readings(spark, sf):
    """Events as raw readings; the load of error events is missing."""
    e = table(spark, sf, "events")
    return e.select("ts", F.when(F.col("event_type") != "error", F.col("value")).alias("load"), "event_id")


def clean_series(spark, sf):
    """Last reading per half hour, kept if missing or in range, capped a little, then filled."""
    from loadtide.operators.dedupe import keep_last_in_slot
    from loadtide.operators.select import range_filter_nullable

    last = materialize(keep_last_in_slot(raw_readings(spark, sf), "ts", 30 * MINUTE, tie_break=["event_id"]))
    kept = range_filter_nullable(last, {"load": (LOW, HIGH)})
    capped = F.when(F.col("load") > 200, F.col("load") * 0.9).when(F.col("load") > 150, F.col("load") * 0.97).otherwise(F.col("load"))
    flagged = kept.select("ts", capped.alias("load"), F.col("load").isNull().alias("is_interpolated"), "event_id")
    return fill_gaps(flagged, "ts", ["load"], cadence=30 * MINUTE)


RAW = f"""raw AS (SELECT ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS load FROM events),
    last AS (SELECT {B30} AS b30, load FROM raw QUALIFY row_number() OVER (PARTITION BY {B30} ORDER BY ts DESC, event_id) = 1),
    kept AS (SELECT b30, CASE WHEN load > 200 THEN load * 0.9::DOUBLE WHEN load > 150 THEN load * 0.97::DOUBLE ELSE load END AS load,
             load IS NULL AS is_interpolated FROM last WHERE load IS NULL OR load BETWEEN 20 AND 300),
    clean AS (SELECT b30, coalesce(load, last_value(load IGNORE NULLS) OVER (ORDER BY b30 ROWS UNBOUNDED PRECEDING),
              first_value(load IGNORE NULLS) OVER (ORDER BY b30 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS load,
              is_interpolated FROM kept)"""
PAIRS = f"""{RAW}, pairs AS (SELECT coalesce(l.b30, c.b30) AS ts, l.load AS load_raw, c.load AS load_clean, c.is_interpolated
    FROM last l FULL JOIN clean c ON l.b30 = c.b30)"""
CLASSES = f"""{PAIRS}, classes AS (SELECT *, CASE
    WHEN load_raw IS NULL AND load_clean IS NULL THEN 'unchanged' WHEN load_clean IS NULL THEN 'removed'
    WHEN load_raw IS NULL THEN 'minor'
    WHEN (load_raw < 20 OR load_raw > 300) AND NOT (load_clean < 20 OR load_clean > 300) THEN 'removed'
    WHEN abs(load_raw - load_clean) / greatest(abs(load_raw), 1) > 0.05 THEN 'major'
    WHEN coalesce(is_interpolated, false) OR load_raw < 20 OR load_raw > 300
      OR abs(load_raw - load_clean) / greatest(abs(load_raw), 1) > 0.01 THEN 'minor' ELSE 'unchanged' END AS correction FROM pairs)"""


def classes(spark, sf):
    pairs = compare.compare_outer(raw_readings(spark, sf), clean_series(spark, sf), "ts", "load", "is_interpolated", tie_break=["event_id"])
    return compare.classify_corrections(pairs, "load", LOW, HIGH)


@query("compare_outer", f"WITH {PAIRS} SELECT * FROM pairs", doubles="load_raw load_clean")
def _(spark, sf):
    return compare.compare_outer(raw_readings(spark, sf), clean_series(spark, sf), "ts", "load", "is_interpolated", tie_break=["event_id"])


@query("classify_corrections", f"WITH {CLASSES} SELECT ts, correction FROM classes")
def _(spark, sf):
    return classes(spark, sf).select("ts", "correction")


@query("correction_summary", f"""
    WITH {CLASSES} SELECT (SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM last) AS n_dedup, count(load_clean) AS n_clean,
        count(*) FILTER (correction <> 'unchanged') AS n_modified,
        count(*) FILTER (correction <> 'unchanged') * 100.0::DOUBLE / greatest(count(*), 1) AS pct_modified,
        count(*) FILTER (correction = 'minor') * 100.0::DOUBLE / greatest(count(load_clean), 1) AS pct_imputed,
        count(*) FILTER (correction = 'removed') AS n_removed, (SELECT count(*) FROM raw) - (SELECT count(*) FROM last) AS duplicates
    FROM classes""", doubles="pct_modified pct_imputed")
def _(spark, sf):
    return compare.correction_summary(classes(spark, sf), "load", raw_readings(spark, sf), "ts")


@query("corrections_per_day", f"""
    WITH {CLASSES} SELECT CAST(ts AS DATE) AS date, count(*) FILTER (correction = 'minor') AS minor,
        count(*) FILTER (correction = 'major') AS major, count(*) FILTER (correction = 'removed') AS removed FROM classes GROUP BY 1""")
def _(spark, sf):
    return compare.corrections_per_day(classes(spark, sf), "ts")


_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, strftime(b30, '%Y-%m-%d') AS period, avg(({cond})::INT) AS rate FROM s0 GROUP BY 2"
    for c, cond in [("load", "load IS NULL OR load < 0 OR load < 40 OR load > 160")] + [(t, f"{t} IS NULL") for t in TYPES])


@query("anomaly_heatmap", f"""
    WITH {S0}, r AS ({_RATES}), top AS (SELECT column_name FROM r GROUP BY 1 ORDER BY avg(rate) DESC, column_name LIMIT 4)
    SELECT column_name, period, rate * 100 AS rate_pct FROM r WHERE column_name IN (SELECT column_name FROM top)""", doubles="rate_pct")
def _(spark, sf):
    """Share of bad cells per day for the four worst columns."""
    return profile.anomaly_heatmap(mix(spark, sf), "b30", ["load", *TYPES], {"load": (40.0, 160.0)},
                                   F.date_format("b30", "yyyy-MM-dd"), top=4)


@query("quality_categories", f"""
    WITH {S0}, k AS (SELECT CASE WHEN load IS NULL OR signup IS NULL OR view IS NULL OR error IS NULL THEN 'missing'
        WHEN NOT load BETWEEN 0 AND 130 THEN 'outlier' ELSE 'valid' END AS k FROM s0)
    SELECT count(*) FILTER (k = 'valid') * 100.0::DOUBLE / count(*) AS valid_pct, count(*) FILTER (k = 'missing') * 100.0::DOUBLE / count(*)
        AS missing_pct, count(*) FILTER (k = 'outlier') * 100.0::DOUBLE / count(*) AS outlier_pct, 0.0::DOUBLE AS partial_pct FROM k""",
       doubles="valid_pct missing_pct outlier_pct partial_pct")
def _(spark, sf):
    return profile.quality_categories(mix(spark, sf), ["load", "signup", "view", "error"], "load", 0.0, 130.0)


@query("quality_categories_partial", f"""
    WITH {S0}, s AS (SELECT load, ((load IS NOT NULL)::INT + (signup IS NOT NULL)::INT + (view IS NOT NULL)::INT + (error IS NOT NULL)::INT) / 4 AS score
        FROM s0), k AS (SELECT CASE WHEN load IS NULL OR score < 0.5 THEN 'missing' WHEN NOT load BETWEEN 0 AND 130 THEN 'outlier'
        WHEN score < 1 THEN 'partial' ELSE 'valid' END AS k FROM s)
    SELECT count(*) FILTER (k = 'valid') * 100.0::DOUBLE / count(*) AS valid_pct, count(*) FILTER (k = 'missing') * 100.0::DOUBLE / count(*)
        AS missing_pct, count(*) FILTER (k = 'outlier') * 100.0::DOUBLE / count(*) AS outlier_pct,
        count(*) FILTER (k = 'partial') * 100.0::DOUBLE / count(*) AS partial_pct FROM k""",
       doubles="valid_pct missing_pct outlier_pct partial_pct")
def _(spark, sf):
    """The same where a row may lack some values and still count as partial."""
    return profile.quality_categories(mix(spark, sf), ["load", "signup", "view", "error"], "load", 0.0, 130.0, min_score=0.5)


@query("volume_summary", f"""
    WITH {S0} SELECT raw, clean, duplicates, greatest(raw - duplicates - clean, 0) AS removed, clean * 100.0::DOUBLE / raw AS retention_pct
    FROM (SELECT (SELECT count(*) FROM lineitem) AS raw, (SELECT count(*) FROM lineitem) - (SELECT count(DISTINCT l_shipdate) FROM lineitem)
          AS duplicates, (SELECT count(DISTINCT o_orderdate) FROM orders) AS clean)""", doubles="retention_pct")
def _(spark, sf):
    raw = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("t"))
    clean = table(spark, sf, "orders").select(F.col("o_orderdate").alias("t")).distinct()
    return compare.volume_summary(raw, clean, "t")


_STATS = """SELECT avg({v}) AS mean, stddev_pop({v}) AS std, min({v}) AS min, max({v}) AS max,
    (count(*) FILTER ({v} < 20 OR {v} > 300))::DOUBLE AS outliers FROM {t}"""


@query("describe_load", f"""
    WITH {RAW} SELECT mean, std, min, max, CAST(outliers AS BIGINT) AS outliers FROM ({_STATS.format(v='load', t='raw')})""",
       doubles="mean std min max")
def _(spark, sf):
    return profile.describe_load(raw_readings(spark, sf), "load", LOW, HIGH)


@query("describe_before_after", f"""
    WITH {RAW}, b AS (UNPIVOT ({_STATS.format(v='load', t='raw')}) ON mean, std, min, max, outliers INTO NAME statistic VALUE before),
    a AS (UNPIVOT ({_STATS.format(v='load', t='clean')}) ON mean, std, min, max, outliers INTO NAME statistic VALUE after)
    SELECT statistic, before, after, CASE WHEN before <> 0 THEN (after - before) / before * 100 END AS change_pct FROM b JOIN a USING (statistic)""",
       doubles="before after change_pct")
def _(spark, sf):
    return profile.describe_before_after(raw_readings(spark, sf), clean_series(spark, sf), "load", LOW, HIGH)


@query("null_profile", f"""
    WITH {S0}, n AS (SELECT count(*) AS n FROM s0) """ + " UNION ALL ".join(
    f"SELECT '{t}' AS column_name, (SELECT n FROM n) AS n, count({t}) AS filled, count({t}) / count(*) AS completeness FROM s0"
    for t in ("load", *TYPES)), doubles="completeness")
def _(spark, sf):
    return profile.null_profile(mix(spark, sf), ["load", *TYPES])


# Raw order totals against totals capped at 450000.
_MONTHS = f"""{O0}, r AS (SELECT strftime(o_orderdate, '%Y-%m') AS label, any_value(date_trunc('month', o_orderdate)) AS p,
        CAST(sum(price) AS DOUBLE) / count(*) AS raw, CAST(sum(least(price, 450000)) AS DOUBLE) / count(*) AS clean
        FROM o0 GROUP BY 1),
    m AS (SELECT label, raw * day(last_day(p)) * 24 / 1000000 AS raw_twh, clean * day(last_day(p)) * 24 / 1000000 AS clean_twh FROM r),
    g AS (SELECT *, (clean_twh - raw_twh) / raw_twh * 100 AS gap_pct FROM m)"""


def _months(spark, sf):
    o = orders(spark, sf)
    capped = o.withColumn("o_totalprice", F.least("o_totalprice", F.lit(450000).cast("decimal(18,2)")))
    return (compare.monthly_energy_mean(o, "o_orderdate", "o_totalprice"),
            compare.monthly_energy_mean(capped, "o_orderdate", "o_totalprice"))


@query("monthly_energy_mean", f"WITH {_MONTHS} SELECT CAST(r.p AS DATE) AS period, m.label, raw_twh AS total_twh FROM m JOIN r USING (label)",
       doubles="total_twh", digits=9)
def _(spark, sf):
    return _months(spark, sf)[0]


@query("month_inner", f"WITH {_MONTHS} SELECT label, raw_twh, clean_twh FROM m", doubles="raw_twh clean_twh", digits=9)
def _(spark, sf):
    return compare.month_inner(*_months(spark, sf))


@query("monthly_compare", f"""
    WITH {_MONTHS} SELECT label, raw_twh, clean_twh, gap_pct, abs(gap_pct) >= 1 AS annotate, abs(gap_pct) >= 3 AS explain FROM g""",
       doubles="raw_twh clean_twh gap_pct", digits=9)
def _(spark, sf):
    return compare.monthly_compare(*_months(spark, sf))


@query("monthly_gap_summary", f"""
    WITH {_MONTHS}, w AS (SELECT * FROM g WHERE gap_pct <> 0 ORDER BY abs(gap_pct) DESC, label LIMIT 1)
    SELECT (SELECT avg(abs(gap_pct)) FROM g) AS mean_abs_gap_pct, label AS max_gap_month, gap_pct AS max_gap_pct, raw_twh, clean_twh,
           abs(gap_pct) >= 3 AS explain FROM w""", doubles="mean_abs_gap_pct max_gap_pct raw_twh clean_twh", digits=9)
def _(spark, sf):
    return compare.monthly_gap_summary(compare.monthly_compare(*_months(spark, sf)))


@query("linear_trend", f"""
    WITH {_MONTHS}, i AS (SELECT (row_number() OVER (ORDER BY label) - 1)::DOUBLE AS x, clean_twh AS y FROM m)
    SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS n FROM i""", doubles="slope intercept")
def _(spark, sf):
    return compare.linear_trend(_months(spark, sf)[1], "label", "total_twh")


@query("histogram_density", """
    WITH b AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM events),
    h AS (SELECT least(floor((value - lo) / ((hi - lo) / 45)), 44)::BIGINT AS bin, count(*) AS n FROM events, b GROUP BY 1)
    SELECT bin, lo + bin * ((hi - lo) / 45) AS bin_low, h.n AS n, h.n / (b.n * ((hi - lo) / 45)) AS density FROM h, b""",
       doubles="bin_low density")
def _(spark, sf):
    return profile.histogram_density(table(spark, sf, "events"), "value")


_KDE = """
    WITH d AS (SELECT CAST(value AS DOUBLE) AS v, count(*)::DOUBLE AS c FROM events GROUP BY 1),
    s AS (SELECT min(value) AS lo, max(value) AS hi, count(*)::DOUBLE AS n, stddev_samp(value) * power(count(*)::DOUBLE, -0.2) AS h FROM events),
    g AS (SELECT i AS grid_index, lo - 0.5 * (hi - lo) + i * (2.0 * (hi - lo) / 999) AS x, n, h FROM s, range(1000) t(i))
    SELECT grid_index, x, sum(c * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi())) AS density
    FROM g, d GROUP BY grid_index, x, n, h"""


@query("kde", _KDE, doubles="x density", digits=8)
def _(spark, sf):
    return profile.kde(table(spark, sf, "events"), "value")
