"""Checks, verdicts, comparison classes and audit views on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadtide.functions import measures as m
from loadtide.operators import audit, compare, quality, regression, rollup
from loadtide.plans import layers
from loadtide.plans.layers import SeriesSpec

START = datetime(2024, 1, 1)


def results(spark, df, **kw):
    checks = [quality.Check("rate", lambda: quality.null_rate("v"), "<=", 0.05), quality.Check("score", lambda: m.mean_of("v"), ">=", 0.75)]
    return {r.check_name: r for r in quality.run_checks(df, checks, "t", **kw).collect()}


def test_no_data_is_neither_pass_nor_zero(spark):
    empty = spark.createDataFrame([], "v double")
    got = results(spark, empty)
    assert {(r.status, r.passed, r.value) for r in got.values()} == {("no_data", False, None)}
    literal = results(spark, empty, null_as_zero=True)
    assert literal["rate"].passed and not literal["score"].passed


def test_errors_do_not_hide_other_checks(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    checks = [quality.Check("bad", lambda: quality.null_rate("nope"), "<=", 0, "critical"), quality.Check("good", lambda: F.count("v"), ">=", 1)]
    out = quality.run_checks(df, checks, "t")
    assert [(r.check_name, r.status) for r in out.collect()] == [("bad", "error"), ("good", "pass")]
    with pytest.raises(Exception, match="nope"):
        quality.run_checks(df, checks, "t", skip_errors=False)
    with pytest.raises(ValueError, match="bad"):
        quality.gate(out, "test")
    assert quality.gate(out, "test", fail_on_critical=False).total == 2


def test_operator_is_checked():
    with pytest.raises(ValueError):
        quality.Check("x", lambda: None, "==", 1)


def test_catalogues():
    names = [c.name for c in quality.monitoring_checks() + quality.monitoring_daily_checks() + quality.monitoring_monthly_checks()
             + quality.monitoring_run_checks() + quality.recent_duplicate_checks()]
    assert len(names) == len(set(names)) == 10
    assert len(quality.post_load_checks()) + len(quality.post_load_daily_checks()) == 5 and len(quality.daily_stream_checks()) == 3
    eased = quality.with_severity(quality.post_load_checks(), {"year_coverage_gaps": "warning"})
    assert {c.name: c.severity for c in eased}["year_coverage_gaps"] == "warning"


@pytest.mark.parametrize("raw,clean,imputed,want", [
    (None, None, None, "unchanged"), (50000.0, None, None, "removed"), (None, 50000.0, True, "minor"), (5000.0, 50000.0, False, "removed"),
    (50000.0, 60000.0, False, "major"), (50000.0, 51000.0, False, "minor"), (50000.0, 50100.0, False, "unchanged"),
    (50000.0, 50100.0, True, "minor"), (50000.0, 50000.0, None, "unchanged"), (5000.0, 5000.0, False, "minor")])
def test_correction_classes(spark, raw, clean, imputed, want):
    df = spark.createDataFrame([(raw, clean, imputed)], "v_raw double, v_clean double, is_interpolated boolean")
    assert compare.classify_corrections(df, "v").first().correction == want


def test_both_sides_hold_one_row_per_slot(spark):
    q = spark.createDataFrame([(START + timedelta(minutes=15 * i), float(i)) for i in range(4)], "t timestamp, v double")
    got = {r.t: (r.v_raw, r.v_clean) for r in compare.compare_outer(q, q, "t", "v").collect()}
    assert got == {START: (1.0, 1.0), START + timedelta(minutes=30): (3.0, 3.0)}


def test_peak_tie_goes_to_the_earliest(spark):
    df = spark.createDataFrame([(START + timedelta(hours=h), v) for h, v in ((9, 5.0), (7, 5.0), (8, 4.0), (10, None))], "t timestamp, v double")
    r = rollup.daily_peak(df, "t", "v").first()
    assert (r.peak_hour, r.peak_value) == (7, 5.0)


def test_year_on_year_needs_the_year_before(spark):
    df = spark.createDataFrame([(2020, 1, 100.0), (2021, 1, 110.0), (2023, 1, 121.0), (2024, 1, 0.0)], "year int, month int, total double")
    guarded = {r.year: r.y for r in rollup.year_on_year(df, "total", name="y").collect()}
    assert guarded[2021] == pytest.approx(10) and guarded[2020] is None and guarded[2023] is None and guarded[2024] == -100
    literal = {r.year: r.y for r in rollup.year_on_year(df, "total", name="y", adjacent_only=False).collect()}
    assert literal[2023] == pytest.approx(10)


def test_cadence_is_a_parameter(spark):
    df = spark.createDataFrame([(8.0,)] * 4, "v double")
    assert df.agg(m.energy_gwh(F.sum("v"), 0.25)).first()[0] == pytest.approx(0.008)


def test_clean_flags_filters_and_scores_before_filling(spark):
    data = [(START + timedelta(minutes=30 * i), v, 1.0, None, 2.0, 3.0) for i, v in enumerate((50000.0, None, 500.0, 60000.0))]
    df = spark.createDataFrame(data, "datetime timestamp, consumption_mw double, nuclear_mw double, wind_mw double, solar_mw double, co2_rate double")
    got = {r.datetime: r for r in layers.clean(df, cut=True).collect()}
    assert len(got) == 3
    r = got[START + timedelta(minutes=30)]
    assert (r.consumption_mw, r.is_interpolated, r.wind_mw) == (50000.0, True, None)
    assert r.completeness_before == pytest.approx(0.6)
    scored = {x.datetime: x.quality_score for x in layers.derive(layers.clean(df)).collect()}
    assert scored[START + timedelta(minutes=30)] == pytest.approx(0.8)


def test_rolling_leak_can_be_shut_out(spark):
    df = spark.createDataFrame([(START + timedelta(minutes=30 * i), float(i)) for i in range(60)], "datetime timestamp, consumption_mw double")
    spec = SeriesSpec(low=0, high=1e9)
    last = START + timedelta(minutes=30 * 59)
    pick = lambda d: d.filter(F.col("datetime") == F.lit(last)).first()
    assert pick(layers.look_back(df, spec)).rolling_24h_mean == pytest.approx(sum(range(12, 60)) / 48)
    assert pick(layers.look_back(df, spec, exclude_current=True)).rolling_24h_mean == pytest.approx(sum(range(12, 59)) / 47)
    assert pick(layers.look_back(df, spec, by_time=False)).rolling_24h_mean == pytest.approx(sum(range(11, 60)) / 49)


def metrics(spark, run="r", extra=()):
    rows = [(run, "LinearRegression", 200.0, 150.0, 3.0, 0.90, 1.0, START), (run, "GradientBoosting", 110.0, 80.0, 2.0, 0.97, 20.0, START),
            (run, "RandomForest", 100.0, 70.0, 1.5, 0.98, 4.0, START), *extra]
    return spark.createDataFrame(rows, audit.METRIC_SCHEMA)


def test_latest_run_counts_all_models(spark):
    old = [("old", "DecisionTree", 1.0, 1.0, 1.0, 1.0, 1.0, START - timedelta(days=1))]
    r = audit.latest_best_summary(metrics(spark, extra=old)).first()
    assert (r.run_id, r.best_model, r.best_rmse, r.models_trained) == ("r", "RandomForest", 100.0, 3)


def test_latest_rows_without_run_id_go_by_time(spark):
    late = [(None, "A", 1.0, 1.0, 1.0, 1.0, 1.0, START + timedelta(hours=1)), (None, "B", 2.0, 1.0, 1.0, 1.0, 1.0, START + timedelta(minutes=58))]
    assert {r.model_name for r in audit.latest_run_rows(metrics(spark, extra=late)).collect()} == {"A", "B"}


def test_ranking_and_narrative(spark):
    rank = {r.model_name: r for r in regression.model_ranking(metrics(spark)).collect()}
    assert rank["RandomForest"].rank == 1 and rank["RandomForest"].best_mae and rank["GradientBoosting"].delta_rmse_pct == pytest.approx(10)
    assert rank["LinearRegression"].r2_gap_pct == pytest.approx(500)
    n = regression.model_narrative(metrics(spark)).first()
    assert (n.best_model, n.reference_model) == ("RandomForest", "LinearRegression")
    assert (n.error_reduction_pct, n.boosting_delta_pct, n.boosting_time_ratio) == (pytest.approx(50), pytest.approx(10), pytest.approx(5))


def test_zero_error_and_constant_label(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (0.0, None)], "a double, p double")
    r = regression.evaluate(df, "a", "p").first()
    assert (r.rmse, r.mae, r.mape_pct, r.r2) == (0.0, 0.0, 0.0, None)


def test_check_rows_round_trip_their_detail(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    rows = audit.check_rows(quality.run_checks(df, [quality.Check("n", lambda: F.count("v"), ">=", 1, description="enough rows")], "t"),
                            "run", "here", F.lit(START))
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    assert audit.recent_checks(rows, years).first().detail == "enough rows"
    failed = rows.withColumn("passed", F.lit(False)).withColumn("check_name", F.lit("year_coverage_gaps"))
    assert audit.recent_checks(failed, years).first().detail == "years present: 2023, 2024"
