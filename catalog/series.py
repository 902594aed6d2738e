"""De-duplication, filling, lags, rolling statistics, gaps and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.functions.timeaxis import DAY, HOUR, MINUTE
from loadtide.operators import dedupe, impute, islands, lookback, order, select
from loadtide.operators.lookback import Lag, Rolling
from loadtide.sources.scratch import materialize

from .base import B30, DEC, S0, SLOT, TYPES, U0, events, mix, query, table, user_series


@query("mix_resample", f"WITH {S0} SELECT * FROM s0", doubles="load " + " ".join(TYPES))
def _(spark, sf):
    return mix(spark, sf)


@query("resample_floor", f"SELECT event_id, {B30} AS slot FROM events")
def _(spark, sf):
    from loadtide.functions.timeaxis import slot_start

    return events(spark, sf).select("event_id", slot_start("ts", 30 * MINUTE).alias("slot"))


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")


@query("dedupe_by_time", f"""
    SELECT {', '.join(LINE)} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus) = 1""", ints="l_linenumber")
def _(spark, sf):
    """One row per order line; the newest shipment wins, then every other column decides."""
    return dedupe.keep_first(
        table(spark, sf, "lineitem").select(*LINE), ["l_orderkey", "l_linenumber"],
        [-F.unix_micros("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
         "l_returnflag", "l_linestatus"])


@query("dedupe_keep_last", f"""
    SELECT user_id, {B30} AS ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, {B30} ORDER BY events.ts DESC, event_id) = 1""")
def _(spark, sf):
    """The last reading of every user in every half hour."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedupe.keep_last_in_slot(e, "ts", 30 * MINUTE, ["user_id"], ["event_id"])


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
       ints="l_linenumber")
def _(spark, sf):
    return dedupe.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("count_duplicates", """
    SELECT sum(n) AS rows, count(*) AS distinct_keys, sum(n - 1) AS duplicates, count(*) FILTER (n > 1) AS duplicated_keys
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
       ints="rows duplicates")
def _(spark, sf):
    return dedupe.count_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("flag_imputed", f"WITH {S0} SELECT b30, " + ", ".join(f"{t} IS NULL AS {t}_was_null" for t in TYPES) + " FROM s0")
def _(spark, sf):
    return impute.flag_missing(mix(spark, sf), TYPES).select("b30", *[f"{t}_was_null" for t in TYPES])


def _filled(c, part):
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY b30 ROWS BETWEEN UNBOUNDED "
            f"PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY b30 "
            f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


@query("ffill_bfill", f"WITH {S0} SELECT b30, {', '.join(_filled(t, 'year(b30)') for t in TYPES)} FROM s0",
       doubles=" ".join(TYPES))
def _(spark, sf):
    """Missing mix values from before, else from after, inside the year."""
    return impute.fill_gaps(mix(spark, sf), "b30", TYPES, period=F.year("b30"), cadence=SLOT).select("b30", *TYPES)


@query("impute_mix", f"WITH {S0} SELECT b30, " + ", ".join(f"{t} IS NULL AS {t}_was_null" for t in TYPES) + ", "
       + ", ".join(_filled(t, "year(b30)") for t in TYPES) + " FROM s0", doubles=" ".join(TYPES))
def _(spark, sf):
    flagged = impute.flag_missing(mix(spark, sf), TYPES)
    return impute.fill_gaps(flagged, "b30", TYPES, period=F.year("b30"), chunk=3 * DAY, cadence=SLOT).select(
        "b30", *[f"{t}_was_null" for t in TYPES], *TYPES)


@query("ffill_bfill_by_user", f"""
    WITH {U0}, h AS (SELECT user_id, b30, CASE WHEN load < 100 THEN load END AS load FROM u0)
    SELECT user_id, b30, {_filled('load', 'user_id')} FROM h""", doubles="load")
def _(spark, sf):
    """Every user's series, with high readings taken out and filled again."""
    low = user_series(spark, sf).withColumn("load", F.when(F.col("load") < 100, F.col("load")))
    return impute.fill_gaps(low, "b30", ["load"], ["user_id"], chunk=4 * DAY, cadence=SLOT).select("user_id", "b30", "load")


@query("lag_rows", f"""
    WITH {S0} SELECT b30, lag(load, 2) OVER w AS lag_1h, lag(load, 48) OVER w AS lag_24h, lag(load, 336) OVER w AS lag_168h
    FROM s0 WINDOW w AS (PARTITION BY year(b30) ORDER BY b30)""", doubles="lag_1h lag_24h lag_168h")
def _(spark, sf):
    return lookback.row_windows(mix(spark, sf).select("b30", "load"), "b30", {
        "lag_1h": Lag("load", 2), "lag_24h": Lag("load", 48), "lag_168h": Lag("load", 336)},
        period=F.year("b30"), cadence=SLOT).drop("load")


@query("lag_time", f"""
    WITH {S0} SELECT s0.b30, a.load AS lag_1h, b.load AS lag_24h, c.load AS lag_168h FROM s0
    LEFT JOIN s0 a ON a.b30 = s0.b30 - INTERVAL 1 HOUR LEFT JOIN s0 b ON b.b30 = s0.b30 - INTERVAL 24 HOUR
    LEFT JOIN s0 c ON c.b30 = s0.b30 - INTERVAL 168 HOUR""", doubles="lag_1h lag_24h lag_168h")
def _(spark, sf):
    return lookback.time_windows(mix(spark, sf).select("b30", "load"), "b30", {
        "lag_1h": Lag("load", HOUR), "lag_24h": Lag("load", 24 * HOUR), "lag_168h": Lag("load", 168 * HOUR)}, cadence=SLOT).drop("load")


# The SQL sums with compensation: the mean of 32 hundredths can lie on a border of seven digits, which a plain sum of doubles misses.
@query("rolling_rows", f"""
    WITH {S0} SELECT b30, favg(load) OVER w AS mean, stddev_samp(load) OVER w AS std
    FROM s0 WINDOW w AS (PARTITION BY year(b30) ORDER BY b30 ROWS BETWEEN 48 PRECEDING AND CURRENT ROW)""",
       doubles="mean std", digits=7)
def _(spark, sf):
    return lookback.row_windows(mix(spark, sf).select("b30", "load"), "b30", {
        "mean": Rolling("load", 48, "mean"), "std": Rolling("load", 48, "std")}, period=F.year("b30"), cadence=SLOT).drop("load")


@query("rolling_time", f"""
    WITH {S0} SELECT b30, avg(load) OVER h6 AS mean_6h, CASE WHEN count(load) OVER d7 >= 72 THEN avg(load) OVER d7 END AS mean_7d
    FROM s0 WINDOW h6 AS (ORDER BY b30 RANGE BETWEEN INTERVAL 21599999999 MICROSECOND PRECEDING AND CURRENT ROW),
    d7 AS (ORDER BY b30 RANGE BETWEEN INTERVAL 604799999999 MICROSECOND PRECEDING AND CURRENT ROW)""",
       doubles="mean_6h mean_7d", digits=7)
def _(spark, sf):
    return lookback.time_windows(mix(spark, sf).select("b30", "load"), "b30", {
        "mean_6h": Rolling("load", 6 * HOUR), "mean_7d": Rolling("load", 7 * DAY, min_count=72)}, cadence=SLOT).drop("load")


@query("rolling_time_by_user", f"""
    WITH {U0} SELECT user_id, b30, avg(load) OVER w AS mean_24h, count(load) OVER w AS n_24h, p.load AS lag_24h
    FROM (SELECT * FROM u0) x LEFT JOIN (SELECT user_id AS pu, b30 + INTERVAL 24 HOUR AS pb, load FROM u0) p
      ON p.pu = x.user_id AND p.pb = x.b30
    WINDOW w AS (PARTITION BY user_id ORDER BY b30 RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW)
    """.replace("avg(load)", "avg(x.load)").replace("count(load)", "count(x.load)"), doubles="mean_24h lag_24h", digits=7)
def _(spark, sf):
    """Last-day mean and day-before value of every user, in one shuffle."""
    return lookback.time_windows(user_series(spark, sf).select("user_id", "b30", "load"), "b30", {
        "mean_24h": Rolling("load", 24 * HOUR), "n_24h": Rolling("load", 24 * HOUR, "count"),
        "lag_24h": Lag("load", 24 * HOUR)}, ["user_id"], chunk=5 * DAY, cadence=SLOT).drop("load")


@query("rolling_exclude_current", f"""
    WITH {S0} SELECT b30, avg(load) OVER w AS mean, stddev_samp(load) OVER w AS std FROM s0
    WINDOW w AS (ORDER BY b30 RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
       doubles="mean std", digits=7)
def _(spark, sf):
    """Last-day statistics without the current value, as a model may use them."""
    return lookback.time_windows(mix(spark, sf).select("b30", "load"), "b30", {
        "mean": Rolling("load", 24 * HOUR, include_current=False),
        "std": Rolling("load", 24 * HOUR, "std", include_current=False)}, cadence=SLOT).drop("load")


@query("rolling_extremes", f"""
    WITH {S0} SELECT b30, min(load) OVER w AS least, max(load) OVER w AS greatest, sum(load) OVER w AS total, stddev_samp(view) OVER w AS view_std
    FROM s0 WINDOW w AS (ORDER BY b30 RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW)""", doubles="least greatest total view_std")
def _(spark, sf):
    """Least, greatest and sum of the last day."""
    return lookback.time_windows(mix(spark, sf).select("b30", "load", "view"), "b30", {
        "least": Rolling("load", 24 * HOUR, "min"), "greatest": Rolling("load", 24 * HOUR, "max"), "total": Rolling("load", 24 * HOUR, "sum"),
        "view_std": Rolling("view", 24 * HOUR, "std")}, cadence=SLOT).drop("load", "view")


@query("rolling_events", """
    SELECT event_id, min(value) OVER w AS least, max(value) OVER w AS greatest, avg(value) OVER w AS mean, count(value) OVER w AS n
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 172799999999 MICROSECOND PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
       doubles="least greatest mean")
def _(spark, sf):
    """What each event had before it in two days of its user's raw, uneven events; pieces are cut by counted rows."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    back = lambda stat: Rolling("value", 48 * HOUR, stat, include_current=False)
    return lookback.time_windows(e, "ts", {"least": back("min"), "greatest": back("max"), "mean": back("mean"), "n": back("count")}, ["user_id"],
                                 chunk=4 * DAY).drop("user_id", "ts", "value")


_ORDER_DAYS = """days AS (SELECT CAST(o_orderdate AS DATE)::TIMESTAMP AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
    FROM orders GROUP BY 1)"""


def order_days(spark, sf):
    """Daily order totals, over seven years."""
    day = F.to_timestamp(F.to_date("o_orderdate")).alias("day")
    return table(spark, sf, "orders").groupBy(day).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"), F.count(F.lit(1)).alias("n"))


@query("row_features_over_years", f"""
    WITH {_ORDER_DAYS} SELECT day, lag(total, 7) OVER y AS lag_7, avg(n) OVER r AS mean_31, stddev_samp(n) OVER r AS std_31, min(total) OVER r AS least_31
    FROM days WINDOW y AS (PARTITION BY year(day) ORDER BY day), r AS (PARTITION BY year(day) ORDER BY day ROWS BETWEEN 30 PRECEDING AND CURRENT ROW)""",
       doubles="lag_7 mean_31 std_31 least_31")
def _(spark, sf):
    """Row lags and rolling columns that start anew each year."""
    return lookback.row_windows(order_days(spark, sf), "day", {
        "lag_7": Lag("total", 7), "mean_31": Rolling("n", 30), "std_31": Rolling("n", 30, "std"), "least_31": Rolling("total", 30, "min")},
        period=F.year("day"), block=100).drop("total", "n")


@query("ffill_over_years", f"""
    WITH {_ORDER_DAYS}, h AS (SELECT day AS b30, n, CASE WHEN dayofyear(day) % 4 > 1 AND dayofyear(day) > 9 THEN total END AS total FROM days)
    SELECT b30 AS day, n, {_filled('total', 'year(b30)')} FROM h""", doubles="total:2")
def _(spark, sf):
    """Gaps filled inside each of seven years, the first days of a year from behind; cut by counted rows into pieces of about forty."""
    turn = F.dayofyear("day")
    holes = order_days(spark, sf).withColumn("total", F.when((turn % 4 > 1) & (turn > 9), F.col("total")))
    return impute.fill_gaps(materialize(holes), "day", ["total"], period=F.year("day"), rows=40).select("day", "n", "total")


@query("gap_split", """
    WITH t AS (SELECT user_id, ts, event_id, value, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 48 HOUR AS g
               FROM events)
    SELECT event_id, CASE WHEN NOT coalesce(g, false) THEN value END AS value, coalesce(g, false) AS after_gap FROM t""")
def _(spark, sf):
    e = table(spark, sf, "events")
    return islands.gap_split(e, "ts", "value", 48 * HOUR, ["user_id"]).select("event_id", "value", "after_gap")


_SEG = """
    WITH t AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w > INTERVAL 24 HOUR THEN 1 ELSE 0 END AS b
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS segment_id FROM t)"""


@query("segment_islands", _SEG + """
    SELECT user_id, segment_id, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS n FROM s GROUP BY 1, 2""",
       ints="segment_id n")
def _(spark, sf):
    """Stretches of every user's events without a silence of more than a day."""
    return islands.segment_islands(table(spark, sf, "events"), "ts", 24 * HOUR, ["user_id"])


@query("label_segments", _SEG + "SELECT event_id, user_id, segment_id FROM s", ints="segment_id")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return islands.label_segments(e, "ts", 24 * HOUR, ["user_id"]).drop("ts")


@query("flag_runs", f"""
    WITH {S0}, f AS (SELECT b30, error IS NULL AS imputed FROM s0),
    r AS (SELECT *, row_number() OVER (ORDER BY b30) - row_number() OVER (PARTITION BY imputed ORDER BY b30) AS g FROM f)
    SELECT imputed, min(b30) AS run_start, max(b30) AS run_end, count(*) AS n FROM r GROUP BY imputed, g""")
def _(spark, sf):
    """Runs of half hours with and without error events."""
    flagged = mix(spark, sf).select("b30", F.col("error").isNull().alias("imputed"))
    return islands.flag_runs(flagged, "b30", "imputed", chunk=5 * DAY, cadence=SLOT)


@query("median_step", f"""
    WITH {U0}, d AS (SELECT epoch_us(b30) - lag(epoch_us(b30)) OVER (PARTITION BY user_id ORDER BY b30) AS s FROM u0)
    SELECT quantile_cont(s, 0.5) / 1000000 AS median_step_s FROM d WHERE s IS NOT NULL""", doubles="median_step_s", digits=5)
def _(spark, sf):
    """Median time between neighbouring half hours of the users' series."""
    return islands.median_step(user_series(spark, sf), "b30", ["user_id"], cadence=SLOT)


@query("every_nth", """
    WITH t AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events)
    SELECT event_id, ts FROM t WHERE i % greatest(n // 400, 1) = 0""")
def _(spark, sf):
    """About 400 evenly spaced events."""
    return order.every_nth(table(spark, sf, "events").select("event_id", "ts"), "ts", max_points=400, tie_break=["event_id"])


@query("every_sixth", f"""
    WITH {S0}, t AS (SELECT b30, load, row_number() OVER (ORDER BY b30) - 1 AS i FROM s0)
    SELECT b30, load FROM t WHERE i % 6 = 0""", doubles="load")
def _(spark, sf):
    return order.every_nth(mix(spark, sf).select("b30", "load"), "b30", step=6, chunk=DAY, block=360 * DAY)


@query("time_prefix", """
    WITH t AS (SELECT l_orderkey, l_linenumber, l_shipdate, row_number() OVER (ORDER BY l_shipdate) AS i, count(*) OVER () AS n
               FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_shipdate FROM t WHERE l_shipdate <= (SELECT max(l_shipdate) FROM t WHERE i <= floor(n * 0.3))""",
       ints="l_linenumber")
def _(spark, sf):
    """The first 30 % of the order lines in time order, ties at the end included."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return order.time_prefix(li, "l_shipdate", lambda n: F.floor(n * F.lit(0.3)))


@query("time_split", f"""
    WITH {S0}, t AS (SELECT b30, row_number() OVER (ORDER BY b30) AS i, count(*) OVER () AS n FROM s0),
    c AS (SELECT max(b30) AS cutoff FROM t WHERE i <= greatest(floor(n * 0.8), 1))
    SELECT cutoff, count(*) FILTER (b30 <= cutoff) AS n_train, count(*) FILTER (b30 > cutoff) AS n_test,
           min(b30) FILTER (b30 > cutoff) AS test_start FROM s0, c GROUP BY 1""")
def _(spark, sf):
    s = materialize(mix(spark, sf).select("b30"))
    train, test = order.time_split(s, "b30")
    row = train.agg(F.max("b30").alias("cutoff"), F.count(F.lit(1)).alias("n_train"))
    return row.select("cutoff", "n_train", test.agg(F.count(F.lit(1))).scalar().alias("n_test"),
                      test.agg(F.min("b30")).scalar().alias("test_start"))


@query("order_statistic", f"""
    WITH v AS (SELECT CAST({DEC} * 100 AS BIGINT) AS v, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events)
    SELECT v AS value FROM v WHERE i = floor((n - 1) / 4)""")
def _(spark, sf):
    """Lower quartile of all event values in hundredths, by counting."""
    cents = events(spark, sf).select((F.col("value") * 100).cast("long").alias("v"))
    quartile = order.select_ranks(cents, F.col("v"), [lambda n: F.floor((n - 1) / 4)])[0]
    return spark.range(1).select(F.lit(quartile).cast("long").alias("value"))


@query("cast_numeric", """
    SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE '1e3' END AS DOUBLE) AS v FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_type") == "error", "n/a").otherwise("1e3").alias("v"))
    return select.cast_numeric(e, ["k", "v", "not_there"])


@query("require_not_null", f"WITH {S0} SELECT b30, error FROM s0 WHERE b30 IS NOT NULL AND error IS NOT NULL", doubles="error")
def _(spark, sf):
    return select.require_not_null(mix(spark, sf).select("b30", "error"), "b30", "error")


@query("range_filter_nullable", f"""
    WITH {S0} SELECT b30, load, error FROM s0 WHERE (error IS NULL OR error BETWEEN 20 AND 200)
    AND (load IS NULL OR load BETWEEN 30 AND 150)""", doubles="load error")
def _(spark, sf):
    return select.range_filter_nullable(mix(spark, sf).select("b30", "load", "error"), {"error": (20, 200), "load": (30, 150)})


@query("is_outlier", f"""
    WITH {S0} SELECT b30, error IS NULL OR error < 0 OR error < 20 OR error > 200 AS outlier FROM s0""")
def _(spark, sf):
    from loadtide.functions.measures import is_outlier

    return mix(spark, sf).select("b30", is_outlier("error", 20, 200).alias("outlier"))


@query("feature_complete", f"WITH {S0} SELECT * FROM s0 WHERE " + " AND ".join(f"{t} IS NOT NULL" for t in TYPES),
       doubles="load " + " ".join(TYPES))
def _(spark, sf):
    from loadtide.functions.measures import all_present

    return mix(spark, sf).filter(all_present(["load", *TYPES]))


@query("available_columns", f"WITH {S0} SELECT b30, view FROM s0", doubles="view")
def _(spark, sf):
    return select.available_columns(mix(spark, sf), ["b30", "tide_mw", "view"])


@query("trailing_window", """
    SELECT event_id, ts, value FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def _(spark, sf):
    return select.trailing_window(table(spark, sf, "events").select("event_id", "ts", "value"), "ts", 7)


@query("recent_view", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""")
def _(spark, sf):
    return select.recent_view(table(spark, sf, "orders"), "o_orderdate", F.lit("2001-08-01").cast("timestamp"), 30,
                              ["o_orderkey", "o_orderdate", "o_totalprice", "not_there"])


@query("window_to_bounds", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN
    (SELECT min(l_shipdate) FROM lineitem WHERE l_returnflag = 'R') AND (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R')""")
def _(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return select.window_to_bounds(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), returned,
                                   "o_orderdate", "l_shipdate")


@query("cross_bounds", """
    WITH b AS (SELECT min(ts) AS min_time, max(ts) AS max_time FROM events)
    SELECT event_id, min_time, max_time FROM events CROSS JOIN b""")
def _(spark, sf):
    return select.cross_bounds(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query("table_bounds", """
    SELECT 'events' AS table_name, count(*) AS n, min(ts) AS min_time, max(ts) AS max_time FROM events
    UNION ALL SELECT 'orders', count(*), min(o_orderdate), max(o_orderdate) FROM orders
    UNION ALL SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem""")
def _(spark, sf):
    return select.table_bounds({
        "events": table(spark, sf, "events").withColumnRenamed("ts", "t"),
        "orders": table(spark, sf, "orders").withColumnRenamed("o_orderdate", "t"),
        "lineitem": table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "t")}, "t")


@query("union_by_name", """
    SELECT c_nationkey AS nationkey, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_nationkey, s_name, NULL FROM supplier""", ints="nationkey")
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_nationkey AS nationkey", "c_name AS name", "c_mktsegment AS segment")
    return select.union_by_name(c, table(spark, sf, "supplier").selectExpr("s_name AS name", "s_nationkey AS nationkey"))


@query("distinct_years", "SELECT DISTINCT year(o_orderdate) AS year FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query("set_difference", """
    SELECT l_orderkey AS key FROM lineitem WHERE l_returnflag = 'N' EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "key")
    return li.filter("l_returnflag = 'N'").select("key").subtract(li.filter("l_returnflag = 'R'").select("key"))


@query("order_by", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(
        F.col("c_acctbal").desc_nulls_last(), "c_custkey")


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20")
def _(spark, sf):
    return order.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                       [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 20)
