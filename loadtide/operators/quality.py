"""Declarative data checks: all metrics of a table in one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import LOAD_MAX, LOAD_MIN
from ..functions.measures import mean_of

RESULT_COLUMNS = ("check_name", "table_name", "severity", "operator", "threshold", "value", "passed", "status", "detail")


@dataclass(frozen=True)
class Check:
    """One aggregate expression compared with a threshold. `operator` is "<=" or ">="."""

    name: str
    metric: Callable[[], Column]
    operator: str
    threshold: float
    severity: str = "warning"
    description: str = ""

    def __post_init__(self):
        if self.operator not in ("<=", ">="):
            raise ValueError(f"operator {self.operator!r} of check {self.name!r} is not <= or >=")


def null_rate(column: str) -> Column:
    return F.try_divide(F.count(F.when(F.col(column).isNull(), 1)).cast("double"), F.count(F.lit(1)).cast("double"))


def out_of_range_rate(column: str, low: float, high: float) -> Column:
    odd = F.count(F.when(~F.col(column).between(low, high), 1)).cast("double")
    return F.coalesce(F.try_divide(odd, F.count(column).cast("double")), F.lit(0.0))


def missing_year_count(year: str) -> Column:
    return F.coalesce(F.max(year) - F.min(year) + 1 - F.count_distinct(year), F.lit(0))


def post_load_checks(load: str = "consumption_mw", score: str = "quality_score", year: str = "year",
                     min_rows: int = 1000, year_gap_severity: str = "critical") -> list[Check]:
    return [
        Check("silver_row_count", lambda: F.count(F.lit(1)), ">=", min_rows, "critical"),
        Check("null_consumption_rate", lambda: null_rate(load), "<=", 0.05, "critical"),
        Check("avg_quality_score", lambda: F.coalesce(mean_of(score), F.lit(0.0)), ">=", 0.75),
        Check("year_coverage_gaps", lambda: missing_year_count(year), "<=", 0, year_gap_severity,
              "No year missing between the first and the last"),
    ]


def post_load_daily_checks(min_days: int = 30) -> list[Check]:
    return [Check("gold_daily_count", lambda: F.count(F.lit(1)), ">=", min_days, "critical")]


def monitoring_checks(load: str = "consumption_mw", score: str = "quality_score", year: str = "year",
                      base_source: str = "nuclear_mw", low: float = LOAD_MIN, high: float = LOAD_MAX,
                      min_rows: int = 10_000, min_base: float = 10_000) -> list[Check]:
    return [
        Check("silver_volume_total", lambda: F.count(F.lit(1)), ">=", min_rows, "critical"),
        Check("score_qualite_global", lambda: F.coalesce(mean_of(score), F.lit(0.0)), ">=", 0.6),
        Check("taux_null_consommation", lambda: null_rate(load), "<=", 0.30),
        Check("plage_consommation_global", lambda: out_of_range_rate(load, low, high), "<=", 0.01),
        Check("annees_distinctes", lambda: F.count_distinct(year), ">=", 1, "critical"),
        Check("coherence_nucleaire", lambda: F.coalesce(mean_of(base_source), F.lit(0.0)), ">=", min_base),
    ]


def monitoring_daily_checks(min_days: int = 100) -> list[Check]:
    return [Check("agg_daily_calcules", lambda: F.count(F.lit(1)), ">=", min_days, "critical")]


def monitoring_monthly_checks() -> list[Check]:
    return [Check("agg_monthly_calcules", lambda: F.count(F.lit(1)), ">=", 1)]


def monitoring_run_checks() -> list[Check]:
    return [Check("pipeline_runs_enregistres", lambda: F.count(F.lit(1)), ">=", 1)]


def recent_duplicate_checks(count: str = "n") -> list[Check]:
    """For a table of keys with their row count, such as `rows_per_key` gives."""
    return [Check("doublons_recents", lambda: F.count(F.when(F.col(count) > 1, 1)), "<=", 0)]


def rows_per_key(df: DataFrame, keys: Sequence[str], since: Column | None = None) -> DataFrame:
    recent = df if since is None else df.filter(since)
    return recent.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def daily_stream_checks(load: str = "consumption_mw", score: str = "quality_score") -> list[Check]:
    return [
        Check("completude_24h", lambda: F.count(F.lit(1)), ">=", 40),
        Check("null_consumption", lambda: null_rate(load), "<=", 0.05),
        Check("avg_quality_score", lambda: mean_of(score), ">=", 0.75),
    ]


def on_day(df: DataFrame, time: str, day: date) -> DataFrame:
    """That day's rows as a range on the time itself, so that the scan can use it."""
    start = F.lit(day).cast("timestamp")
    return df.filter((F.col(time) >= start) & (F.col(time) < F.lit(day).cast("timestamp") + F.expr("interval 1 day")))


def with_severity(checks: Sequence[Check], overrides: Mapping[str, str]) -> list[Check]:
    return [replace(c, severity=overrides.get(c.name, c.severity)) for c in checks]


def _row(check: Check, table: str, value: Column, error: str | None, null_as_zero: bool) -> Column:
    if error is not None:
        value, passed, status = F.lit(None).cast("double"), F.lit(False), F.lit("error")
    else:
        value = F.coalesce(value, F.lit(0.0)) if null_as_zero else value
        ok = value <= check.threshold if check.operator == "<=" else value >= check.threshold
        passed = F.coalesce(ok, F.lit(False))
        failed = "critical" if check.severity == "critical" else "warning"
        status = F.when(value.isNull(), "no_data").when(passed, "pass").otherwise(failed)
    fields = {
        "check_name": F.lit(check.name), "table_name": F.lit(table), "severity": F.lit(check.severity),
        "operator": F.lit(check.operator), "threshold": F.lit(float(check.threshold)), "value": value,
        "passed": passed, "status": status, "detail": F.lit(error if error is not None else check.description),
    }
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def run_checks(df: DataFrame, checks: Sequence[Check], table: str, *, skip_errors: bool = True,
               null_as_zero: bool = False) -> DataFrame:
    """One result row per check. The table is read once for all of them.

    A metric over no rows gives the status "no_data" and does not pass; with `null_as_zero`
    it is compared as 0. A check that cannot be resolved on this table is an "error" row, or
    raises if errors are not skipped; the others still run.
    """
    errors: dict[str, str] = {}
    metrics = []
    for i, c in enumerate(checks):
        try:
            metric = c.metric().cast("double").alias(f"m{i}")
            df.agg(metric)
            metrics.append(metric)
        except AnalysisException as exc:
            if not skip_errors:
                raise
            errors[c.name] = exc.getCondition() or "error"
            metrics.append(F.max(F.lit(None).cast("double")).alias(f"m{i}"))
    values = df.agg(*metrics)
    rows = [_row(c, table, F.col(f"m{i}"), errors.get(c.name), null_as_zero) for i, c in enumerate(checks)]
    return values.select(F.inline(F.array(*rows)))


def union_results(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionAll(r)
    return out


def verdict(results: DataFrame) -> DataFrame:
    """Totals, score in percent, names of failed checks, overall flags."""
    failed = ~F.col("passed")
    critical = F.col("severity") == "critical"

    def names(cond: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("check_name")))), ", ")

    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("passed"), 1)).alias("passed"),
        F.try_divide(F.count(F.when(F.col("passed"), 1)) * 100.0, F.count(F.lit(1))).alias("score_pct"),
        names(failed & critical).alias("failed_critical"), names(failed & ~critical).alias("failed_warning"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"))


def gate(results: DataFrame, source: str, fail_on_critical: bool = True, fail_on_warning: bool = False):
    """Raise when a blocking check failed. Reads the one-row verdict; returns it otherwise."""
    v = verdict(results).first()
    blocking = [n for n, on in ((v.failed_critical, fail_on_critical), (v.failed_warning, fail_on_warning)) if on and n]
    if blocking:
        raise ValueError(f"quality checks failed ({source}): {', '.join(blocking)}")
    return v


def quality_report(results: DataFrame) -> DataFrame:
    """Printable rows: check, value, limit, PASS / WARNING / CRITICAL."""
    status = (F.when(F.col("passed"), "PASS").when(F.col("severity") == "critical", "CRITICAL").otherwise("WARNING"))
    return results.select(
        "check_name", F.round("value", 4).alias("actual_value"),
        F.concat_ws(" ", "operator", F.col("threshold").cast("string")).alias("limit"), status.alias("result"))


def integer_gaps(df: DataFrame, value: str, keys: Sequence[str] = (), name: str = "missing") -> DataFrame:
    """Whole numbers between each key's smallest and largest that do not occur (years, days).

    Distinct values first; then each value only looks at the next one, so a gap is produced
    from its two ends and nothing is collected.
    """
    from pyspark.sql import Window

    seen = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("long").alias("__v")).distinct()
    nxt = F.lead("__v").over(Window.partitionBy(*keys).orderBy("__v"))
    return (seen.withColumn("__next", nxt).filter(F.col("__next") - F.col("__v") > 1)
            .select(*keys, F.explode(F.sequence(F.col("__v") + 1, F.col("__next") - 1)).alias(name)))


def year_gaps(df: DataFrame, time: str) -> DataFrame:
    return integer_gaps(df.select(F.year(time).alias("year")), "year", name="year")


def source_inventory(records: DataFrame, file: str = "source_file", time: str = "datetime") -> DataFrame:
    """Per source file: usable rows, first and last time, years covered."""
    return records.groupBy(file).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("min_time"), F.max(time).alias("max_time"),
        F.array_join(F.sort_array(F.collect_set(F.year(time))), ",").alias("years"))


def source_verdict(records: DataFrame, calendar: DataFrame, time: str = "datetime", day: str = "date") -> DataFrame:
    """Years covered, years missing in between, years only the calendar knows, and pass or fail."""
    years = records.select(F.year(time).alias("y")).filter("y is not null").agg(F.sort_array(F.collect_set("y")).alias("a"))
    cal = calendar.select(F.year(day).alias("y")).filter("y is not null").agg(F.sort_array(F.collect_set("y")).alias("a"))
    covered, known = F.col("a"), cal.scalar()
    span = F.when(F.size(covered) > 0, F.sequence(F.array_min(covered), F.array_max(covered)))
    gaps = F.coalesce(F.array_except(span, covered), F.array().cast("array<int>"))
    text = lambda a: F.array_join(a, ",")
    return years.select(
        text(covered).alias("years_covered"), text(gaps).alias("year_gaps"),
        text(F.array_except(known, covered)).alias("calendar_only_years"),
        ((F.size(covered) > 0) & (F.size(gaps) == 0)).alias("passed"))


def run_status(verdicts: DataFrame, ml_skipped: Column) -> DataFrame:
    """Overall status from a verdict row: failed, success_with_warnings or success."""
    return verdicts.withColumn("status", F.when(F.length("failed_critical") > 0, "failed")
                               .when((F.length("failed_warning") > 0) | ml_skipped, "success_with_warnings")
                               .otherwise("success"))


def ml_ready(df: DataFrame, columns: Sequence[str], min_rows: int = 1000) -> DataFrame:
    """Rows usable for training, and whether there are enough. Same predicate as the training filter."""
    from ..functions.measures import all_present

    return df.filter(all_present(columns)).agg(F.count(F.lit(1)).alias("ready_rows")).withColumn(
        "ready", F.col("ready_rows") >= min_rows)
