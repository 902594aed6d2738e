"""Plans that must hold at size: hot keys, scans, broadcasts, window groups."""

import re

from pyspark.sql import functions as F

import catalog
from loadtide.functions.timeaxis import HOUR
from loadtide.operators import dedupe, impute, islands, lookback, quality, rollup, select
from loadtide.operators.lookback import Lag, Rolling
from loadtide.operators.rollup import DailySpec

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=3000):
    """One key with a third of the rows and as many copies of one time."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "timestamp_seconds(CASE WHEN id % 3 = 0 THEN 0 ELSE id * 60 END) AS t", "double(id) AS v")


def test_dedupe_limits_groups_before_the_shuffle(spark):
    p = plan(dedupe.keep_first(hot(spark), ["k", "t"], ["v"]))
    assert p.count("WindowGroupLimit") == 2 and p.count("Exchange hashpartitioning") == 1
    assert dedupe.keep_first(hot(spark), ["k", "t"], ["v"]).count() == 2001


def test_daily_rollup_is_one_scan_and_one_shuffle(spark):
    df = catalog.base.events(spark, SMALL).withColumnRenamed("ts", "datetime").withColumnRenamed("value", "consumption_mw")
    p = plan(rollup.daily_rollup(df, DailySpec(sources={}, exchanges=None)))
    assert p.count("FileScan") == 1 and len(re.findall(r"Exchange ", p)) == 1
    assert "Window" not in p and "Join" not in p
    assert "props" not in p


def test_rolling_and_lags_share_one_shuffle(spark):
    df = spark.range(1000).selectExpr("timestamp_seconds(id * 1800) AS t", "double(id) AS v")
    p = plan(lookback.time_windows(df, "t", {"a": Lag("v", HOUR), "b": Lag("v", 24 * HOUR), "c": Rolling("v", 6 * HOUR)}))
    assert len(re.findall(r"Exchange ", p)) == 1 and "Join" not in p
    assert "SinglePartition" not in p


def test_no_operator_puts_a_series_in_one_task(spark):
    df = spark.range(1000).selectExpr("timestamp_seconds(id * 1800) AS t", "double(id) AS v", "id % 5 = 0 AS f")
    for out in (impute.fill_gaps(df, "t", ["v"]), lookback.row_windows(df, "t", {"a": Lag("v", 2)}), islands.flag_runs(df, "t", "f")):
        # The only unpartitioned windows run over one row per chunk, after an aggregate.
        for single in re.findall(r"Exchange SinglePartition.*?\n(.*)\n", plan(out)):
            assert "HashAggregate" in single or "Project" in single


def test_checks_of_a_table_read_it_once(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    checks = [quality.Check(f"c{i}", lambda: quality.null_rate("o_totalprice"), "<=", 1) for i in range(5)]
    assert plan(quality.run_checks(df, checks, "orders")).count("FileScan") == 1


def test_trailing_window_reaches_the_scan(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "ts")
    p = plan(select.trailing_window(df, "ts", 3))
    assert "Join" not in p and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_time_split_is_pushed_to_the_scan(spark):
    from loadtide.operators.order import time_split

    df = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr("o_orderkey", "timestamp(o_orderdate) AS t")
    train, _ = time_split(df, "t")
    assert "Exchange" not in plan(train)


def test_hot_segment_key(spark):
    """A key whose rows all share one time is one bucket before any ordering."""
    out = islands.segment_islands(hot(spark), "t", HOUR, ["k"])
    assert out.filter("k = 0").first().n == 1000
    assert "partial_min" in plan(out)


def test_rows_and_daily_stay_whole_under_skew(spark):
    df = hot(spark).withColumnRenamed("t", "datetime").withColumnRenamed("v", "consumption_mw")
    daily = rollup.daily_rollup(df, DailySpec(sources={}, exchanges=None, keys=("k",)))
    assert daily.agg(F.sum("records_count")).first()[0] == 3000
