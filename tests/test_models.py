"""Fitted models against numpy, files left unread, the four models of the job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import catalog
from loadtide.plans import training
from loadtide.sources import files, tsv

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 2))
    y = 3 + x @ [2.0, -1.5] + rng.normal(scale=0.1, size=400) + 50
    data = [(i, float(a), float(b), float(c), float(i % 24)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "i int, a double, b double, y double, hour double").withColumn("t", F.timestamp_seconds(F.col("i") * 1800)).cache(), x, y


def test_least_squares_and_metrics(spark, rows, tmp_path):
    df, x, y = rows
    train, test = training.split(df, "t")
    n = train.count()
    plain = training.plain_estimators("y")
    got = training.train_and_compare(train, test, ["a", "b"], "y", str(tmp_path), models={
        "LeastSquares": (plain["LeastSquares"], ["a", "b"]), "Stump": (plain["Stump"], ["hour"])}).collect()
    design = np.c_[np.ones(n), x[:n]]
    e = y[n:] - np.c_[np.ones(400 - n), x[n:]] @ np.linalg.lstsq(design, y[:n], rcond=None)[0]
    ls = next(r for r in got if r.model_name == "LeastSquares")
    np.testing.assert_allclose([ls.rmse, ls.mae, ls.mape_pct, ls.r2], [
        np.sqrt((e ** 2).mean()), np.abs(e).mean(), 100 * np.abs(e / y[n:]).mean(), 1 - (e ** 2).sum() / ((y[n:] - y[n:].mean()) ** 2).sum()], rtol=1e-8)
    assert training.select_best(spark.createDataFrame(got), str(tmp_path)) == "LeastSquares"


def test_learning_curve_of_least_squares(rows):
    df, x, y = rows
    train, test = training.split(df, "t")
    s = training.ModelSettings(curve_min_rows=30)
    got = training.learning_curve(train, test, ["a", "b"], "y", "t", s, training.plain_estimators("y")["LeastSquares"]).collect()
    for r in got:
        c = np.linalg.lstsq(np.c_[np.ones(r.train_rows), x[:r.train_rows]], y[:r.train_rows], rcond=None)[0]
        e = y[320:] - np.c_[np.ones(80), x[320:]] @ c
        assert r.train_rows == int(320 * r.train_fraction) and abs(r.rmse_validation - np.sqrt((e ** 2).mean())) < 1e-8


def test_the_four_models(spark):
    got = {r.model_name: r for r in catalog.QUERIES["fit_all_models"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == {"LinearRegression", "DecisionTree", "RandomForest", "GradientBoosting"}
    label = catalog.models.split_features(spark, "/root/testdata/sf0.01")[1].agg(F.stddev_pop("consumption_mw"), F.count("consumption_mw")).first()
    for r in got.values():
        assert 0 < r.mae <= r.rmse < 2 * label[0] and r.r2 < 1 and 0 < r.mape_pct < 200
    again = {r.model_name: r for r in catalog.QUERIES["fit_all_models"](spark, "/root/testdata/sf0.01").collect()}
    assert again == got  # seeds are fixed


def test_files_of_other_kinds_stay_unread(spark, tmp_path):
    for name in ("a_Annuel_1.xls", "b_Annuel_2.xls", "c_tempo.xls", "notes.xls", "d_Annuel_3.txt"):
        (tmp_path / name).write_text("x\n")
    lines = tsv.read_lines(spark, str(tmp_path), glob="*.xls", where=files.is_kind("annual"))
    assert sorted(r.source_file for r in lines.collect()) == ["a_Annuel_1.xls", "b_Annuel_2.xls"]
    scan = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2
