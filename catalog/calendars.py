"""Calendar, cyclic, ratio and text expressions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loadtide.functions import calendar as cal
from loadtide.functions import measures as m
from loadtide.functions import parsing
from loadtide.operators import rollup

from .base import O0, S0, SLOT, TYPES, events, mix, orders, query, table


@query("parse_cells", """
    SELECT event_id, CASE event_type WHEN 'click' THEN value WHEN 'view' THEN value WHEN 'signup' THEN 12.5 END AS number,
           CASE WHEN event_type IN ('error', 'purchase') THEN NULL ELSE event_type END AS word FROM events""", doubles="number")
def _(spark, sf):
    """Decimal commas, padded cells, missing-value marks and text that is no number."""
    e, t = table(spark, sf, "events"), F.col("event_type")
    digits = F.format_string("%.2f", "value")
    cell = (F.when(t == "click", F.replace(digits, F.lit("."), F.lit(","))).when(t == "view", F.concat(F.lit("  "), digits, F.lit(" ")))
            .when(t == "signup", F.lit("12,5")).when(t == "error", "ND").otherwise("12,5,6"))
    word = F.when(t == "error", "n/a").when(t == "purchase", " - ").otherwise(F.concat(t, F.lit(" ")))
    return e.select("event_id", parsing.parse_number(cell).alias("number"), parsing.parse_text(word).alias("word"))


@query("build_event_time", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 870 MINUTE WHEN '5-LOW' THEN NULL
           ELSE o_orderdate END AS at FROM orders""")
def _(spark, sf):
    o, p = table(spark, sf, "orders"), F.col("o_orderpriority")
    day = F.when(p == "5-LOW", "2024-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    clock = F.when(p == "1-URGENT", "14:30").when(p == "2-HIGH", "").otherwise(F.lit(None))
    return o.select("o_orderkey", parsing.event_time(day, clock).alias("at"))


@query("build_event_time_formats", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def _(spark, sf):
    """ISO text with an offset, without one, and plain text."""
    e, t = table(spark, sf, "events"), F.col("event_type")
    text = (F.when(t == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
            .when(t == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", parsing.parse_instant(text).alias("at"))


@query("calendar_parts", """
    SELECT o_orderkey, hour(o_orderdate) AS hour, dayofweek(o_orderdate) + 1 AS day_of_week, dayofyear(o_orderdate) AS day_of_year,
           weekofyear(o_orderdate) AS week_of_year, month(o_orderdate) AS month, year(o_orderdate) AS year,
           quarter(o_orderdate) AS quarter FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", *[e.alias(n) for n, e in cal.calendar_parts("o_orderdate").items()])


_DOW = "dayofweek(b30)"


@query("is_weekend", f"WITH {S0} SELECT b30, {_DOW} IN (0, 6) AS is_weekend FROM s0")
def _(spark, sf):
    return mix(spark, sf).select("b30", cal.is_weekend("b30").alias("is_weekend"))


@query("is_peak_hour", f"WITH {S0} SELECT b30, hour(b30) BETWEEN 8 AND 20 AND {_DOW} NOT IN (0, 6) AS is_peak FROM s0")
def _(spark, sf):
    return mix(spark, sf).select("b30", cal.is_peak_hour("b30").alias("is_peak"))


_SEASON = ("CASE WHEN month({t}) IN (12, 1, 2) THEN 0 WHEN month({t}) IN (3, 4, 5) THEN 1 "
           "WHEN month({t}) IN (6, 7, 8) THEN 2 ELSE 3 END")


@query("season", f"SELECT o_orderkey, {_SEASON.format(t='o_orderdate')} AS season FROM orders", ints="season")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", cal.season("o_orderdate").alias("season"))


@query("cyclic_encode", f"""
    WITH {S0} SELECT b30, sin(2 * pi() * hour(b30) / 24) AS hour_sin, cos(2 * pi() * hour(b30) / 24) AS hour_cos FROM s0""",
       doubles="hour_sin hour_cos")
def _(spark, sf):
    sin, cos = cal.cyclic(F.hour("b30"), 24)
    return mix(spark, sf).select("b30", sin.alias("hour_sin"), cos.alias("hour_cos"))


@query("calendar_features", f"""
    WITH {S0} SELECT b30, hour(b30) AS hour, {_DOW} + 1 AS dow, dayofyear(b30) AS doy, weekofyear(b30) AS week,
        month(b30) AS month, quarter(b30) AS quarter, {_SEASON.format(t='b30')} AS season, {_DOW} IN (0, 6) AS weekend,
        hour(b30) BETWEEN 8 AND 20 AND {_DOW} NOT IN (0, 6) AS peak,
        sin(2 * pi() * hour(b30) / 24) AS sin, cos(2 * pi() * hour(b30) / 24) AS cos FROM s0""",
       doubles="sin cos", ints="season")
def _(spark, sf):
    p = cal.calendar_parts("b30")
    sin, cos = cal.cyclic(p["hour"], 24)
    return mix(spark, sf).select(
        "b30", p["hour"].alias("hour"), p["day_of_week"].alias("dow"), p["day_of_year"].alias("doy"),
        p["week_of_year"].alias("week"), p["month"].alias("month"), p["quarter"].alias("quarter"),
        cal.season("b30").alias("season"), cal.is_weekend("b30").alias("weekend"), cal.is_peak_hour("b30").alias("peak"),
        sin.alias("sin"), cos.alias("cos"))


@query("share_pct", f"""
    WITH {S0} SELECT b30, CASE WHEN load > 0 THEN (coalesce(view, 0) + coalesce(click, 0) + coalesce(signup, 0)) / load * 100 END
        AS renewable_pct, CASE WHEN load > 0 THEN purchase / load * 100 END AS base_pct FROM s0""",
       doubles="renewable_pct base_pct")
def _(spark, sf):
    return mix(spark, sf).select("b30", m.share_pct(["view", "click", "signup"], "load").alias("renewable_pct"),
                                 m.plain_share_pct("purchase", "load").alias("base_pct"))


@query("forecast_error", f"""
    WITH {S0} SELECT b30, load - view AS error, CASE WHEN load > 0 THEN abs(load - view) / load * 100 END AS error_pct FROM s0""",
       doubles="error error_pct")
def _(spark, sf):
    return mix(spark, sf).select("b30", m.forecast_error("load", "view").alias("error"),
                                 m.forecast_error_pct("load", "view").alias("error_pct"))


_PARTS = " + ".join(f"({t} IS NOT NULL)::INT" for t in TYPES)


@query("completeness_score", f"WITH {S0} SELECT b30, ({_PARTS}) / 5 AS score FROM s0", doubles="score")
def _(spark, sf):
    return mix(spark, sf).select("b30", m.completeness(TYPES).alias("score"))


@query("shares_errors", f"""
    WITH {S0}, f AS (SELECT b30, load, view, purchase, ({_PARTS}) / 5 AS completeness_before,
        coalesce(view, last_value(view IGNORE NULLS) OVER (ORDER BY b30 ROWS UNBOUNDED PRECEDING),
            first_value(view IGNORE NULLS) OVER (ORDER BY b30 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled,
        signup, click, error FROM s0)
    SELECT b30, completeness_before, ((signup IS NOT NULL)::INT + (purchase IS NOT NULL)::INT + (filled IS NOT NULL)::INT
        + (click IS NOT NULL)::INT + (error IS NOT NULL)::INT) / 5 AS completeness_after,
        CASE WHEN load > 0 THEN purchase / load * 100 END AS share, load - filled AS err FROM f""",
       doubles="completeness_before completeness_after share err")
def _(spark, sf):
    """Score before and after filling one source, with share and error."""
    from loadtide.operators.impute import fill_gaps

    s = mix(spark, sf).withColumn("completeness_before", m.completeness(TYPES))
    filled = fill_gaps(s, "b30", ["view"], cadence=SLOT)
    return filled.select("b30", "completeness_before", m.completeness(TYPES).alias("completeness_after"),
                         m.plain_share_pct("purchase", "load").alias("share"), m.forecast_error("load", "view").alias("err"))


@query("holiday_weekend_flag", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, dayofweek(o_orderdate) IN (0, 6) OR strftime(o_orderdate, '%m-%d') IN
        ('01-01', '05-01', '05-08', '07-14', '08-15', '11-01', '11-11', '12-25') AS off FROM orders""")
def _(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", cal.holiday_weekend_flag("day").alias("off"))


@query("label_map", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS label FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", m.label_map("o_orderstatus", {"F": "filled", "O": "open"}).alias("label"))


@query("scale_units", f"""
    WITH {O0} SELECT yr AS year, CAST(sum(price) AS DOUBLE) * 0.5 / 1000 AS gwh, CAST(sum(price) AS DOUBLE) * 0.5 / 1000 / 1000 AS twh
    FROM o0 GROUP BY 1""", doubles="gwh twh")
def _(spark, sf):
    gwh = m.energy_gwh(F.sum("o_totalprice"), 0.5)
    return orders(spark, sf).groupBy("year").agg(gwh.alias("gwh"), (gwh / 1000).alias("twh"))


@query("month_label", """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS label, day(last_day(o_orderdate)) * 24 AS hours FROM orders""")
def _(spark, sf):
    return table(spark, sf, "orders").select(cal.month_label("o_orderdate").alias("label"),
                                             cal.hours_in_month("o_orderdate").alias("hours")).distinct()


@query("fmt_range", """
    SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') || ' → ' || strftime(max(o_orderdate), '%Y-%m-%d') AS period
    FROM orders GROUP BY 1""")
def _(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        cal.fmt_range(F.min("o_orderdate"), F.max("o_orderdate")).alias("period"))


@query("json_props", """
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean
    FROM events GROUP BY 1""", doubles="mean")
def _(spark, sf):
    k = F.get_json_object("props", "$.k").try_cast("long").alias("k")
    return events(spark, sf).groupBy(k).agg(F.count(F.lit(1)).alias("n"), m.mean_of("value").alias("mean"))


@query("json_detail", """
    SELECT event_id, CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k') ELSE 'plain ' || event_type END AS detail
    FROM events""")
def _(spark, sf):
    """A key of a JSON detail, or the text itself where it is not JSON."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").alias("k")
    text = F.when(F.col("event_type") == "click", parsing.json_detail([k, "event_type"])).otherwise(
        F.concat(F.lit("plain "), "event_type"))
    return e.select("event_id", parsing.detail_text(text, "k").alias("detail"))


@query("calendar_join", """
    WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
    cal AS (SELECT day, CASE dayofyear(day) % 3 WHEN 0 THEN 'BLEU' WHEN 1 THEN 'BLANC' ELSE 'ROUGE' END AS colour FROM days)
    SELECT o_orderkey, colour FROM orders LEFT JOIN cal ON cal.day = CAST(o_orderdate AS DATE)""")
def _(spark, sf):
    return rollup.calendar_join(table(spark, sf, "orders"), day_colours(spark, sf), "o_orderdate", "day",
                                ["colour"]).select("o_orderkey", "colour")


def day_colours(spark, sf):
    """One row per shipping day with a colour."""
    days = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    turn = F.dayofyear("day") % 3
    return days.withColumn("colour", F.when(turn == 0, "BLEU").when(turn == 1, "BLANC").otherwise("ROUGE"))


@query("colour_days", """
    WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
    cal AS (SELECT day, CASE dayofyear(day) % 3 WHEN 0 THEN 'BLEU' WHEN 1 THEN 'BLANC' ELSE 'ROUGE' END AS colour FROM days)
    SELECT year(day) AS year, month(day) AS month, count(*) FILTER (colour = 'BLEU') AS bleu_days,
           count(*) FILTER (colour = 'BLANC') AS blanc_days, count(*) FILTER (colour = 'ROUGE') AS rouge_days
    FROM cal GROUP BY 1, 2""")
def _(spark, sf):
    return rollup.colour_days(day_colours(spark, sf), "day", "colour", ["BLEU", "BLANC", "ROUGE"])
