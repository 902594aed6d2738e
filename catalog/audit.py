"""Run, check and metric records: orders stand for runs, order lines for checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.functions.measures import mean_of
from loadtide.operators import audit, quality

from .base import O0, orders, query, table

AS_OF = "2001-08-01"


def now():
    return F.lit(AS_OF).cast("timestamp")

RUNS = """runs AS (SELECT o_orderkey AS run_id, o_orderpriority AS dag_id,
    CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'success' ELSE 'running' END AS status, o_orderdate AS started_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_minutes(o_custkey) END AS finished_at,
    CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice)::BIGINT END AS rows_written FROM orders)"""
CHECKS = """checks AS (SELECT l_orderkey AS id, l_returnflag AS check_name, l_linestatus AS table_name, l_discount < 0.05 AS passed,
    l_quantity AS actual_value, l_shipdate AS checked_at,
    CASE WHEN l_tax > 0.04 THEN '{"human_detail":"part ' || l_partkey || '"}' ELSE 'part ' || l_partkey END AS detail FROM lineitem)"""
METRICS = f"""{O0}, metrics AS (SELECT CAST(yr AS VARCHAR) AS run_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'LinearRegression'
    WHEN '2-HIGH' THEN 'DecisionTree' WHEN '3-MEDIUM' THEN 'RandomForest' WHEN '5-LOW' THEN 'GradientBoosting' ELSE 'my_model' END AS model_name,
    CAST(sum(price) AS DOUBLE) / count(*) / 777 AS rmse, CAST(sum(price) AS DOUBLE) / count(*) / 999 AS mae,
    CAST(max(price) AS DOUBLE) / 70007 AS mape_pct, 1 - count(*) / 7777 AS r2, count(*) / 7 AS train_time_s, max(o_orderdate) AS trained_at
    FROM o0 GROUP BY 1, 2)"""


def runs(spark, sf):
    o, s = table(spark, sf, "orders"), F.col("o_orderstatus")
    end = F.timestamp_micros(F.unix_micros("o_orderdate") + F.col("o_custkey") * 60_000_000)
    return o.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("dag_id"),
        F.when(s == "F", "failed").when(s == "O", "success").otherwise("running").alias("status"),
        F.col("o_orderdate").alias("started_at"), F.when(s != "P", end).alias("finished_at"),
        F.when(s != "F", F.floor("o_totalprice")).alias("rows_written"))


def checks(spark, sf):
    li = table(spark, sf, "lineitem")
    part = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    detail = F.when(F.col("l_tax") > 0.04, F.to_json(F.struct(part.alias("human_detail")))).otherwise(part)
    return li.select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("check_name"), F.col("l_linestatus").alias("table_name"),
        (F.col("l_discount") < 0.05).alias("passed"), F.col("l_quantity").alias("actual_value"),
        F.col("l_shipdate").alias("checked_at"), detail.alias("detail"))


def metrics(spark, sf):
    p = F.col("o_orderpriority")
    name = (F.when(p == "1-URGENT", "LinearRegression").when(p == "2-HIGH", "DecisionTree").when(p == "3-MEDIUM", "RandomForest")
            .when(p == "5-LOW", "GradientBoosting").otherwise("my_model"))
    n = F.count(F.lit(1)).cast("double")
    return orders(spark, sf).groupBy(F.col("year").cast("string").alias("run_id"), name.alias("model_name")).agg(
        (mean_of("o_totalprice") / 777).alias("rmse"), (mean_of("o_totalprice") / 999).alias("mae"),
        (F.max("o_totalprice").cast("double") / 70007).alias("mape_pct"), (1 - n / 7777).alias("r2"), (n / 7).alias("train_time_s"),
        F.max("o_orderdate").alias("trained_at"))


@query("status_rollup", f"""
    WITH {RUNS} SELECT dag_id, status, count(*) AS run_count, avg(rows_written) AS avg_rows, max(started_at) AS last_run,
        count(*) FILTER (status = 'failed') AS failures FROM runs GROUP BY 1, 2""", doubles="avg_rows")
def _(spark, sf):
    return audit.status_rollup(runs(spark, sf))


@query("count_by_status", f"WITH {RUNS} SELECT status, count(*) AS n FROM runs GROUP BY 1")
def _(spark, sf):
    return audit.count_by(runs(spark, sf), "status")


@query("recent_runs", f"""
    WITH {RUNS} SELECT *, round(epoch(finished_at - started_at), 1) AS duration_s FROM runs
    ORDER BY coalesce(finished_at, started_at) DESC NULLS LAST, run_id LIMIT 25""", doubles="duration_s")
def _(spark, sf):
    return audit.recent_runs(runs(spark, sf))


@query("recent_checks", f"""
    WITH {CHECKS} SELECT check_name, table_name, passed, actual_value, checked_at,
        CASE WHEN check_name = 'R' AND NOT passed THEN (SELECT 'years present: ' || string_agg(DISTINCT year(o_orderdate)::VARCHAR, ', ' ORDER BY year(o_orderdate)::VARCHAR) FROM orders) WHEN detail LIKE '{{%'
        THEN json_extract_string(detail, '$.human_detail') ELSE substr(detail, 1, 120) END AS detail FROM checks
    ORDER BY checked_at DESC NULLS LAST, check_name, table_name, id, actual_value LIMIT 20""")
def _(spark, sf):
    ties = ("check_name", "table_name", "id", "actual_value")
    return audit.recent_checks(checks(spark, sf), orders(spark, sf), gap_check="R", tie_break=ties).drop("id")


@query("pass_rate", f"""
    WITH {CHECKS} SELECT round(100.0::DOUBLE * count(*) FILTER (passed) / nullif(count(*), 0), 1) AS pass_rate_pct FROM checks
    WHERE checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""", doubles="pass_rate_pct", digits=1)
def _(spark, sf):
    return audit.pass_rate(checks(spark, sf), now())


@query("recent_failures", f"""
    WITH {RUNS} SELECT count(*) AS failures FROM runs WHERE status IN ('failed', 'error')
    AND started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def _(spark, sf):
    return audit.recent_failures(runs(spark, sf), now())


@query("recent_failed_checks", f"""
    WITH {CHECKS} SELECT * FROM checks WHERE NOT passed AND checked_at >= TIMESTAMP '{AS_OF}' - INTERVAL 48 HOUR""")
def _(spark, sf):
    return audit.recent_failed_checks(checks(spark, sf), now(), hours=48)


@query("best_per_run", f"WITH {METRICS} SELECT run_id, min(rmse) AS rmse, max(trained_at) AS trained_at FROM metrics GROUP BY 1",
       doubles="rmse")
def _(spark, sf):
    return audit.best_per_run(metrics(spark, sf))


_LATEST = f"{METRICS}, latest AS (SELECT * FROM metrics WHERE run_id = (SELECT arg_max(run_id, trained_at) FROM metrics))"


@query("latest_run_rows", f"WITH {_LATEST} SELECT * FROM latest", doubles="rmse mae mape_pct r2 train_time_s")
def _(spark, sf):
    return audit.latest_run_rows(metrics(spark, sf))


@query("latest_best_summary", f"""
    WITH {_LATEST} SELECT run_id, arg_min(model_name, rmse) AS best_model, min(rmse) AS best_rmse, count(DISTINCT model_name)
        AS models_trained FROM latest GROUP BY 1""", doubles="best_rmse")
def _(spark, sf):
    return audit.latest_best_summary(metrics(spark, sf))


_VIEW = """SELECT row_number() OVER (ORDER BY rmse ASC NULLS LAST) AS rank, CASE model_name WHEN 'LinearRegression' THEN
    'Régression linéaire' WHEN 'DecisionTree' THEN 'Arbre de décision' WHEN 'RandomForest' THEN 'Forêt aléatoire'
    WHEN 'GradientBoosting' THEN 'Gradient Boosting' ELSE model_name END AS algorithm, round(rmse, 1) AS rmse, round(mae, 1) AS mae,
    round(mape_pct, 2) AS mape_pct, round(r2, 4) AS r2, round(train_time_s, 1) AS train_time_s,
    round((rmse / nullif(min(rmse) OVER (), 0) - 1) * 100, 1) AS rmse_gap_pct,
    row_number() OVER (ORDER BY rmse ASC NULLS LAST) = 1 AS is_best FROM latest"""


@query("latest_model_view", f"WITH {_LATEST} {_VIEW}", doubles="rmse mae mape_pct r2 train_time_s rmse_gap_pct", digits=4)
def _(spark, sf):
    return audit.model_rank_view(audit.latest_run_rows(metrics(spark, sf)))


@query("row_number_rank", f"WITH {_LATEST} SELECT rank, algorithm FROM ({_VIEW}) WHERE is_best")
def _(spark, sf):
    return audit.model_rank_view(audit.latest_run_rows(metrics(spark, sf))).filter("is_best").select("rank", "algorithm")


@query("audit_append", f"""
    SELECT 'rows' AS check_name, 1::DOUBLE AS expected_value, (SELECT count(*) FROM orders)::DOUBLE AS actual_value, true AS passed
    UNION ALL SELECT 'null_price', 0, (SELECT count(*) FILTER (o_totalprice IS NULL) / count(*) FROM orders), true""",
       doubles="expected_value actual_value")
def _(spark, sf):
    """Check results written to an audit table and read back."""
    from loadtide.sources.publish import publish_append, read_table
    from loadtide.sources.scratch import fresh_path

    results = quality.run_checks(table(spark, sf, "orders"), [
        quality.Check("rows", lambda: F.count(F.lit(1)), ">=", 1, "critical"),
        quality.Check("null_price", lambda: quality.null_rate("o_totalprice"), "<=", 0)], "orders")
    path = fresh_path(spark, "audit")
    publish_append(audit.check_rows(results, "run-1", "audit", now()), path)
    return read_table(spark, path).select("check_name", "expected_value", "actual_value", "passed")


@query("metric_rows", f"""
    WITH {_LATEST} SELECT model_name, round(rmse, 1) AS rmse, round(mape_pct, 2) AS mape_pct, round(r2, 4) AS r2 FROM latest""",
       doubles="rmse mape_pct r2", digits=4)
def _(spark, sf):
    """Metrics rounded the way they are stored."""
    latest = audit.latest_run_rows(metrics(spark, sf))
    return audit.metric_rows(latest, "r", now()).select("model_name", "rmse", "mape_pct", "r2")
