"""Run, check and model-metric records, and the views over them.

These tables hold one row per run, check or trained model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import MODEL_LABELS
from ..functions.measures import label_map
from ..functions.parsing import detail_text, json_detail

RUN_SCHEMA = ("run_id string, dag_id string, run_type string, source_file string, status string, "
              "started_at timestamp, finished_at timestamp, rows_read bigint, rows_written bigint, "
              "rows_skipped bigint, rows_errored bigint, bronze_path string, silver_path string, "
              "gold_path string, error_message string, metadata string")
METRIC_SCHEMA = ("run_id string, model_name string, rmse double, mae double, mape_pct double, r2 double, "
                 "train_time_s double, trained_at timestamp")

# Decimals kept when model metrics are stored.
METRIC_DIGITS = {"rmse": 1, "mae": 1, "mape_pct": 2, "r2": 4, "train_time_s": 1}


def run_rows(counts: DataFrame, run_id: str, dag_id: str, run_type: str, started_at: Column, finished_at: Column,
             paths: Mapping[str, str] | None = None, error: str | None = None) -> DataFrame:
    """Run records, one per input file, in the shape of the audit table.

    `counts` has source_file, rows_read, rows_written, rows_skipped and rows_errored. A run with an error, or in which
    every row read was an error, has failed; one with some errors is partial.
    """
    all_bad = (F.col("rows_read") > 0) & (F.col("rows_errored") >= F.col("rows_read"))
    status = F.when(F.lit(error is not None) | all_bad, "failed").when(F.col("rows_errored") > 0, "partial").otherwise("success")
    values = {
        "run_id": F.lit(run_id), "dag_id": F.lit(dag_id), "run_type": F.lit(run_type), "status": status, "started_at": started_at,
        "finished_at": finished_at, "error_message": F.lit(error), "metadata": json_detail(["source_file", "rows_read"]),
        **{f"{layer}_path": F.lit((paths or {}).get(layer)) for layer in ("bronze", "silver", "gold")}}
    fields = [f.split() for f in RUN_SCHEMA.split(", ")]
    return counts.select(*[values.get(n, F.col(n)).cast(t).alias(n) for n, t in fields])


def check_rows(results: DataFrame, run_id: str, source: str, checked_at: Column) -> DataFrame:
    """Check results in the shape of the audit table; the full result goes into `detail` as JSON."""
    detail = json_detail([F.struct(*results.columns).alias("result"), F.lit(source).alias("source"),
                          F.col("detail").alias("human_detail")])
    return results.select(
        F.lit(run_id).alias("run_id"), "check_name", "table_name", F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("check_type"), F.col("threshold").alias("expected_value"),
        F.col("value").alias("actual_value"), "passed", detail.alias("detail"),
        checked_at.cast("timestamp").alias("checked_at"))


def metric_rows(metrics: DataFrame, run_id: str, trained_at: Column) -> DataFrame:
    return metrics.select(
        F.lit(run_id).alias("run_id"), "model_name",
        *[F.round(c, d).alias(c) for c, d in METRIC_DIGITS.items()], trained_at.cast("timestamp").alias("trained_at"))


def status_rollup(runs: DataFrame, group: str = "dag_id") -> DataFrame:
    return runs.groupBy(group, "status").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.try_divide(F.sum("rows_written").cast("double"), F.count("rows_written")).alias("avg_rows"),
        F.max("started_at").alias("last_run"), F.count(F.when(F.col("status") == "failed", 1)).alias("failures"))


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def recent_runs(runs: DataFrame, k: int = 25, tie_break: str = "run_id") -> DataFrame:
    """Newest runs by end time (start time while running), with their duration in seconds."""
    when = F.coalesce("finished_at", "started_at")
    seconds = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000
    return (runs.withColumn("duration_s", F.round(seconds, 1))
            .orderBy(when.desc_nulls_last(), F.col(tie_break)).limit(k))


def recent_checks(checks: DataFrame, years: DataFrame, k: int = 20, year: str = "year",
                  gap_check: str = "year_coverage_gaps", tie_break: Sequence[str] = ("check_name", "table_name")) -> DataFrame:
    """Newest checks with a readable detail; a failed year check lists the years present. Checks of one instant go by `tie_break`."""
    present = years.filter(F.col(year).isNotNull()).agg(
        F.array_join(F.sort_array(F.collect_set(F.col(year).cast("string"))), ", ")).scalar()
    listed = F.concat(F.lit("years present: "), F.when(F.length(present) > 0, present).otherwise("(none)"))
    text = F.when((F.col("check_name") == gap_check) & ~F.col("passed"), listed).otherwise(detail_text("detail", "human_detail"))
    return (checks.withColumn("detail", text)
            .orderBy(F.col("checked_at").desc_nulls_last(), *tie_break).limit(k))


def pass_rate(checks: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = checks.filter(F.col("checked_at") >= as_of - F.make_dt_interval(F.lit(days)))
    ok = F.count(F.when(F.col("passed"), 1))
    return recent.agg(F.round(F.try_divide(ok * 100.0, F.count(F.lit(1))), 1).alias("pass_rate_pct"))


def recent_failures(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = runs.filter(F.col("status").isin("failed", "error")
                         & (F.col("started_at") >= as_of - F.make_dt_interval(F.lit(days))))
    return recent.agg(F.count(F.lit(1)).alias("failures"))


def recent_failed_checks(checks: DataFrame, as_of: Column, hours: int = 2) -> DataFrame:
    since = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    return (checks.filter(~F.col("passed") & (F.col("checked_at") >= since))
            .orderBy(F.col("checked_at").desc(), "check_name"))


def best_per_run(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("run_id").agg(F.min("rmse").alias("rmse"), F.max("trained_at").alias("trained_at"))


def latest_run_rows(metrics: DataFrame, minutes: int = 5) -> DataFrame:
    """Rows of the newest run; where that run has no id, the rows of the last few minutes."""
    newest = F.max(F.when(F.col("trained_at").isNotNull(), F.struct("trained_at", "run_id")))
    last = metrics.agg(newest).scalar()
    since = last["trained_at"] - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return metrics.filter(F.when(last["run_id"].isNotNull(), F.col("run_id") == last["run_id"])
                          .otherwise(F.col("trained_at") >= since))


def latest_best_summary(metrics: DataFrame) -> DataFrame:
    """Best model, its error, and how many models the newest run trained."""
    return latest_run_rows(metrics).groupBy("run_id").agg(
        F.min(F.struct("rmse", "model_name")).alias("b"), F.count_distinct("model_name").alias("models_trained")
    ).select("run_id", F.col("b.model_name").alias("best_model"), F.col("b.rmse").alias("best_rmse"), "models_trained")


def model_rank_view(metrics: DataFrame, labels: Mapping[str, str] = MODEL_LABELS) -> DataFrame:
    """Models of one run ranked by error, with rounded metrics and the gap to the best in percent."""
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("rmse").asc_nulls_last(), "model_name")
    best = F.min("rmse").over(everything)
    gap = F.try_divide(F.col("rmse"), F.nullif(best, F.lit(0.0))) - 1
    return metrics.select(
        F.row_number().over(order).alias("rank"), label_map("model_name", labels).alias("algorithm"),
        *[F.round(c, d).alias(c) for c, d in METRIC_DIGITS.items()],
        F.round(gap * 100, 1).alias("rmse_gap_pct")).withColumn("is_best", F.col("rank") == 1)
