"""Prediction errors, rankings, bias curves, and model fits on the half-hour series."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.fixed import FEATURE_COLUMNS
from loadtide.functions.timeaxis import HOUR
from loadtide.operators import regression
from loadtide.operators.lookback import Lag, time_windows
from loadtide.operators.select import available
from loadtide.plans import layers, training
from loadtide.sources.scratch import fresh_path, materialize

from .base import S0, SLOT, U0, mix, query, user_series
from .rollups import CLEAN_SQL, SERIES, national

LABEL, TIME = "consumption_mw", "datetime"


def naive(spark, sf):
    """Half-hour load with the value of a day before as its prediction."""
    return time_windows(mix(spark, sf).select("b30", "load"), "b30", {"predicted": Lag("load", 24 * HOUR)}, cadence=SLOT)


NAIVE = f"{S0}, p AS (SELECT s0.b30, s0.load, q.load AS predicted FROM s0 LEFT JOIN s0 q ON q.b30 = s0.b30 - INTERVAL 24 HOUR)"
_METRICS = """sqrt(avg(power(load - predicted, 2))) AS rmse, avg(abs(load - predicted)) AS mae,
    avg(abs(load - predicted) / load) FILTER (load > 0) * 100 AS mape_pct,
    1 - sum(power(load - predicted, 2)) / (var_pop(load) FILTER (predicted IS NOT NULL) * count(predicted)) AS r2"""


@query("naive_baseline", f"WITH {NAIVE} SELECT * FROM p", doubles="load predicted")
def _(spark, sf):
    return naive(spark, sf)


@query("evaluate", f"WITH {NAIVE} SELECT {_METRICS} FROM p", doubles="rmse mae mape_pct r2")
def _(spark, sf):
    return regression.evaluate(naive(spark, sf), "load", "predicted")


@query("evaluate_by_user", f"""
    WITH {U0}, p AS (SELECT u0.user_id, u0.b30, u0.load, q.load AS predicted FROM u0 JOIN u0 q ON q.user_id = u0.user_id
        AND q.b30 = u0.b30 - INTERVAL 24 HOUR)
    SELECT user_id, sqrt(avg(power(load - predicted, 2))) AS rmse, avg(abs(load - predicted)) AS mae FROM p GROUP BY 1""",
       doubles="rmse mae")
def _(spark, sf):
    """Errors of every user's day-before prediction."""
    pairs = time_windows(user_series(spark, sf).select("user_id", "b30", "load"), "b30",
                         {"predicted": Lag("load", 24 * HOUR)}, ["user_id"], chunk=240 * HOUR, cadence=SLOT).filter("predicted IS NOT NULL")
    return regression.evaluate(pairs, "load", "predicted", ["user_id"]).select("user_id", "rmse", "mae")


@query("prediction_metrics", f"""WITH {NAIVE} SELECT {_METRICS.replace('FILTER (load > 0)', 'FILTER (load <> 0)')} FROM p""",
       doubles="rmse mae mape_pct r2")
def _(spark, sf):
    return regression.evaluate(naive(spark, sf), "load", "predicted", positive_only=False)


@query("naive_metrics", f"WITH {NAIVE} SELECT count(predicted) AS n, {_METRICS} FROM p", doubles="rmse mae mape_pct r2")
def _(spark, sf):
    m = regression.error_metrics("load", "predicted")
    return naive(spark, sf).agg(F.count("predicted").alias("n"), *[c.alias(n) for n, c in m.items()])


@query("error_band", f"""
    WITH {NAIVE}, e AS (SELECT *, load - predicted AS error FROM p WHERE predicted IS NOT NULL)
    SELECT *, abs(error) <= (SELECT 2 * sqrt(avg(error * error)) FROM e) AS in_band, CASE WHEN error > 0 THEN 'under' ELSE 'over' END
        AS direction FROM e""", doubles="load predicted error")
def _(spark, sf):
    return regression.error_band(naive(spark, sf), "load", "predicted")


@query("segment_mae", f"""
    WITH {U0}, p AS (SELECT user_id, b30, load, n * 30.0::DOUBLE AS predicted FROM u0),
    t AS (SELECT *, CASE WHEN b30 - lag(b30) OVER w > INTERVAL 24 HOUR THEN 1 ELSE 0 END AS b FROM p WINDOW w AS (PARTITION BY user_id ORDER BY b30)),
    s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY b30 ROWS UNBOUNDED PRECEDING) AS segment_id FROM t)
    SELECT user_id, segment_id, count(*) AS n, min(b30) AS segment_start, max(b30) AS segment_end, avg(abs(load - predicted)) AS mae
    FROM s GROUP BY 1, 2""", doubles="mae:8", ints="segment_id")
def _(spark, sf):
    """Mean error of every contiguous block of every user's predictions."""
    preds = user_series(spark, sf).withColumn("predicted", F.col("n") * 30.0).drop("n")
    return regression.segment_mae(preds, "b30", "load", "predicted", keys=["user_id"])


LAGS = {"LinearRegression": 24, "GradientBoosting": 48, "RandomForest": 1, "lag_168": 168}
_MODELS = f"""{S0}, metrics AS (""" + " UNION ALL ".join(
    f"SELECT '{n}' AS model_name, {_METRICS}, {h}.0::DOUBLE AS train_time_s FROM (SELECT s0.b30, s0.load, q.load AS predicted FROM s0 "
    f"LEFT JOIN s0 q ON q.b30 = s0.b30 - INTERVAL {h} HOUR) p{h}" for n, h in LAGS.items()) + ")"


def lag_models(spark, sf):
    """Errors of predictors with several lags, in one pass."""
    wide = time_windows(mix(spark, sf).select("b30", "load"), "b30", {n: Lag("load", h * HOUR) for n, h in LAGS.items()}, cadence=SLOT)
    tall = wide.select("load", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model_name"), F.lit(float(h)).alias("train_time_s"), F.col(n).alias("predicted"))
        for n, h in LAGS.items()])))
    m = regression.error_metrics("load", "predicted")
    return tall.groupBy("model_name", "train_time_s").agg(*[c.alias(n) for n, c in m.items()])


@query("model_ranking", f"""
    WITH {_MODELS} SELECT model_name, CASE model_name WHEN 'LinearRegression' THEN 'Régression linéaire' WHEN 'RandomForest' THEN
        'Forêt aléatoire' WHEN 'GradientBoosting' THEN 'Gradient Boosting' ELSE replace(model_name, '_', ' ') END AS label,
        rmse, mae, mape_pct, r2, row_number() OVER (ORDER BY rmse) AS rank, (rmse / min(rmse) OVER () - 1) * 100 AS delta_rmse_pct,
        rmse / min(rmse) OVER () * 100 AS rmse_pct_of_best, (1 - r2) / greatest(1 - max(r2) OVER (), 1e-6) * 100 AS r2_gap_pct,
        rmse = min(rmse) OVER () AS best_rmse, mae = min(mae) OVER () AS best_mae, mape_pct = min(mape_pct) OVER () AS best_mape,
        r2 = max(r2) OVER () AS best_r2 FROM metrics""", doubles="rmse mae mape_pct r2 delta_rmse_pct rmse_pct_of_best r2_gap_pct")
def _(spark, sf):
    return regression.model_ranking(lag_models(spark, sf))


@query("model_narrative", f"""
    WITH {_MODELS}, b AS (SELECT * FROM metrics ORDER BY rmse LIMIT 1), w AS (SELECT * FROM metrics ORDER BY rmse DESC LIMIT 1),
    l AS (SELECT * FROM metrics WHERE model_name = 'LinearRegression'), g AS (SELECT * FROM metrics WHERE model_name = 'GradientBoosting')
    SELECT b.model_name AS best_model, CASE WHEN l.rmse > b.rmse THEN l.model_name ELSE w.model_name END AS reference_model,
        (1 - b.rmse / CASE WHEN l.rmse > b.rmse THEN l.rmse ELSE w.rmse END) * 100 AS error_reduction_pct,
        (g.rmse / b.rmse - 1) * 100 AS boosting_delta_pct, g.train_time_s / greatest(b.train_time_s, 0.1) AS boosting_time_ratio
    FROM b, w, l, g""", doubles="error_reduction_pct boosting_delta_pct boosting_time_ratio")
def _(spark, sf):
    return regression.model_narrative(lag_models(spark, sf))


@query("loess_bias", f"""
    WITH {S0}, d AS (SELECT load AS x, view AS y FROM s0 WHERE load IS NOT NULL AND view IS NOT NULL),
    b AS (SELECT min(x) AS lo, max(x) AS hi, count(*) AS n, least(greatest(floor(count(*) * 0.08), 3), count(*) - 1)::BIGINT AS k FROM d),
    g AS (SELECT i AS grid_index, lo + i * ((hi - lo) / 299) AS x0, k FROM b, range(300) t(i)),
    h AS (SELECT grid_index, x0, greatest(list_sort(list(abs(x - x0)))[any_value(k) + 1], 1e-9) AS h FROM g, d GROUP BY 1, 2),
    w AS (SELECT grid_index, x0, x - x0 AS u, y, power(greatest(1 - power(abs(x - x0) / h, 3), 0), 3) AS w FROM h, d),
    s AS (SELECT grid_index, x0, sum(w) AS sw, sum(w * u) / sum(w) AS um, sum(w * y) / sum(w) AS ym FROM w GROUP BY 1, 2),
    c AS (SELECT w.grid_index, w.x0, any_value(ym) AS ym, any_value(um) AS um, sum(w * (u - um) * (y - ym)) AS num,
          sum(w * (u - um) * (u - um)) AS den FROM w JOIN s USING (grid_index) GROUP BY 1, 2)
    SELECT grid_index, x0 AS x, CASE WHEN den < 1e-12 THEN ym ELSE ym - num / den * um END AS y FROM c""",
       doubles="x y", digits=5)
def _(spark, sf):
    """Smooth curve of one source against the load."""
    return regression.loess(materialize(mix(spark, sf)), "load", "view")


# Fits on the clean series. The rolling columns leave out the value being predicted.
def features(spark, sf):
    rows = layers.engineer(layers.clean(national(spark, sf), SERIES), SERIES, exclude_current=True)
    return materialize(training.load_training(rows, LABEL))


@query("load_training", f"""
    WITH {CLEAN_SQL} SELECT a.datetime, a.consumption_mw, b.consumption_mw AS lag_24h_mw FROM clean a JOIN clean b
    ON b.datetime = a.datetime - INTERVAL 24 HOUR WHERE a.consumption_mw IS NOT NULL AND b.consumption_mw IS NOT NULL""",
       doubles="consumption_mw:8 lag_24h_mw:8")
def _(spark, sf):
    rows = layers.engineer(layers.clean(national(spark, sf), SERIES), SERIES)
    return training.load_training(rows, LABEL).select(TIME, LABEL, "lag_24h_mw")


_READY = f"""WITH {CLEAN_SQL}, look AS (SELECT c.*, a.consumption_mw AS l1, b.consumption_mw AS l24, d.consumption_mw AS l168,
        count(c.consumption_mw) OVER (ORDER BY c.datetime RANGE BETWEEN INTERVAL '86399.999999 seconds' PRECEDING
            AND INTERVAL '0.000001 seconds' PRECEDING) AS n24
        FROM clean c LEFT JOIN clean a ON a.datetime = c.datetime - INTERVAL 1 HOUR LEFT JOIN clean b ON b.datetime = c.datetime - INTERVAL 24 HOUR
        LEFT JOIN clean d ON d.datetime = c.datetime - INTERVAL 168 HOUR),
    trainable AS (SELECT *, row_number() OVER (ORDER BY datetime) AS i, count(*) OVER () AS n FROM look
        WHERE consumption_mw IS NOT NULL AND l24 IS NOT NULL),
    parts AS (SELECT *, datetime <= (SELECT max(datetime) FROM trainable WHERE i <= greatest(floor(n * 0.8::DOUBLE), 1)) AS train,
        nuclear_mw IS NOT NULL AND wind_mw IS NOT NULL AND solar_mw IS NOT NULL AND hydro_mw IS NOT NULL AND co2_rate IS NOT NULL
        AND forecast_j1_mw IS NOT NULL AND l1 IS NOT NULL AND l168 IS NOT NULL AND n24 >= 2 AS ready FROM trainable)"""
IN_VECTOR = {"hour": "hour(datetime)::DOUBLE", "nuclear_mw": "nuclear_mw", "lag_1h_mw": "l1", "lag_24h_mw": "l24", "lag_168h_mw": "l168", "forecast_j1_mw": "forecast_j1_mw"}


@query("assemble_features", f"{_READY} SELECT datetime, 22 AS n_features, {', '.join(f'{e} AS {n}' for n, e in IN_VECTOR.items())} FROM parts WHERE ready",
       doubles=" ".join(IN_VECTOR))
def _(spark, sf):
    """Complete rows; five of the 27 candidate columns aren't in this series. Some entries are read back from the vector."""
    from pyspark.ml.functions import vector_to_array

    rows = features(spark, sf)
    at = {n: k for k, n in enumerate(available(rows, FEATURE_COLUMNS))}
    v = training.assemble_features(rows).select(TIME, vector_to_array("features").alias("v"))
    return v.select(TIME, F.size("v").alias("n_features"), *[F.col("v")[at[n]].alias(n) for n in IN_VECTOR])


_SPLIT = f"""WITH {CLEAN_SQL}, f AS (SELECT a.datetime FROM clean a JOIN clean b ON b.datetime = a.datetime - INTERVAL 24 HOUR
        WHERE a.consumption_mw IS NOT NULL AND b.consumption_mw IS NOT NULL),
    i AS (SELECT datetime, row_number() OVER (ORDER BY datetime) AS i, count(*) OVER () AS n FROM f),
    s AS (SELECT datetime, datetime <= (SELECT max(datetime) FROM i WHERE i <= greatest(floor(n * 0.8), 1)) AS train FROM f)"""


@query("split_summary", f"""
    {_SPLIT} SELECT count(*) FILTER (train) AS n_train, count(*) FILTER (NOT train) AS n_test, min(datetime) FILTER (train) AS train_start,
        max(datetime) FILTER (train) AS train_end, min(datetime) FILTER (NOT train) AS test_start, max(datetime) FILTER (NOT train)
        AS test_end FROM s""")
def _(spark, sf):
    train, test = training.split(features(spark, sf), TIME)
    return training.split_summary(train, test, TIME)


@query("materialize_split", f"{_SPLIT} SELECT datetime, CASE WHEN train THEN 'train' ELSE 'test' END AS part FROM s")
def _(spark, sf):
    """Both parts of the split, written once and read back."""
    train, test = training.split(features(spark, sf), TIME)
    return train.select(TIME, F.lit("train").alias("part")).unionAll(test.select(TIME, F.lit("test").alias("part")))


def split_features(spark, sf):
    rows = features(spark, sf)
    names = available(rows, FEATURE_COLUMNS)
    return (*training.split(rows, TIME), names)


# Models with one right answer, so that every figure has a twin in SQL: least squares on two lags by normal equations, and
# the split of the hours that leaves the least squared error.
LS = ("lag_1h_mw", "lag_24h_mw")
_FIT = """saa * sbb - sab * sab AS det, (say * sbb - sby * sab) / det AS ca, (sby * saa - say * sab) / det AS cb, my - ca * ma - cb * mb AS c0"""
_SUMS = """count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) AS saa, covar_pop(b, b) AS sbb, covar_pop(a, b) AS sab,
    covar_pop(y, a) AS say, covar_pop(y, b) AS sby"""
_TWINS = f"""{_READY},
    rows AS (SELECT datetime, train, consumption_mw::DOUBLE AS y, l1::DOUBLE AS a, l24::DOUBLE AS b, hour(datetime) AS h FROM parts),
    ls AS (SELECT {_FIT} FROM (SELECT {_SUMS} FROM rows WHERE train AND a IS NOT NULL)),
    cuts AS (SELECT t, avg(y) FILTER (h <= t) AS below, avg(y) FILTER (h > t) AS above, var_pop(y) FILTER (h <= t) * count(*) FILTER (h <= t)
        + var_pop(y) FILTER (h > t) * count(*) FILTER (h > t) AS sse FROM rows, range(23) r(t) WHERE train GROUP BY t),
    stump AS (SELECT t, below, above FROM cuts ORDER BY sse LIMIT 1),
    scored AS (SELECT 'LeastSquares' AS model_name, datetime, y AS load, c0 + ca * a + cb * b AS predicted FROM rows, ls WHERE NOT train AND a IS NOT NULL
        UNION ALL SELECT 'Stump', datetime, y, CASE WHEN h <= t THEN below ELSE above END FROM rows, stump WHERE NOT train),
    metrics AS (SELECT model_name, {_METRICS} FROM scored GROUP BY model_name)"""


def plain_models():
    plain = training.plain_estimators(LABEL)
    return {"LeastSquares": (plain["LeastSquares"], LS), "Stump": (plain["Stump"], ["hour"])}


@query("fit_models", f"{_TWINS} SELECT model_name, rmse, mae, mape_pct, r2 FROM metrics", doubles="rmse mae mape_pct r2")
def _(spark, sf):
    """Models fitted, scored, saved and compared."""
    train, test, names = split_features(spark, sf)
    return training.train_and_compare(train, test, names, LABEL, training.model_path(spark), models=plain_models()).drop("train_time_s")


@query("model_coefficients", f"""{_TWINS} SELECT 'LeastSquares' AS model_name, c0 AS first, ca AS second, cb AS third FROM ls
    UNION ALL SELECT 'Stump', t + 0.5, below, above FROM stump""", doubles="first second third")
def _(spark, sf):
    """What was fitted: intercept and coefficients; threshold and the two means."""
    train, _, _ = split_features(spark, sf)
    ls, stump = (training.fit(train, used, e).stages[-1] for e, used in plain_models().values())
    tree = stump._java_obj.rootNode()
    rows = [("LeastSquares", ls.intercept, *map(float, ls.coefficients)),
            ("Stump", tree.split().threshold(), tree.leftChild().prediction(), tree.rightChild().prediction())]
    return spark.createDataFrame(rows, "model_name string, first double, second double, third double")


@query("score_export", f"{_TWINS} SELECT datetime, load AS actual, predicted FROM scored WHERE model_name = 'LeastSquares'", doubles="actual predicted")
def _(spark, sf):
    """Actual and predicted values on the test rows, in time order."""
    train, test, _ = split_features(spark, sf)
    estimator, used = plain_models()["LeastSquares"]
    return training.score_export(training.fit(train, used, estimator), test, TIME, LABEL)


@query("select_best", f"{_TWINS} SELECT datetime, load AS actual, predicted FROM scored WHERE model_name = (SELECT arg_min(model_name, rmse) FROM metrics)", doubles="actual predicted")
def _(spark, sf):
    """The best model, saved, loaded again and used on every test row."""
    from pyspark.ml import PipelineModel

    train, test, names = split_features(spark, sf)
    path = fresh_path(spark, "models")
    training.select_best(training.train_and_compare(train, test, names, LABEL, path, models=plain_models()), path)
    return training.score_export(PipelineModel.load(f"{path}/best"), test, TIME, LABEL)


_CURVE = f"""{_READY},
    rows AS (SELECT datetime, train, consumption_mw::DOUBLE AS y, l1::DOUBLE AS a, l24::DOUBLE AS b FROM parts WHERE l1 IS NOT NULL),
    ranked AS (SELECT *, row_number() OVER (ORDER BY datetime) AS i, count(*) OVER () AS size FROM rows WHERE train),
    part AS (SELECT f, ranked.* FROM ranked, (SELECT unnest([0.15, 0.3, 0.5, 0.65, 0.8, 1.0]::DOUBLE[]) AS f) WHERE i <= greatest(floor(size * f), least(size, 500), 1)),
    fitted AS (SELECT f, n, {_FIT} FROM (SELECT f, {_SUMS} FROM part GROUP BY f)),
    curve AS (SELECT f AS train_fraction, n AS train_rows, rmse_train, rmse_validation FROM fitted
        JOIN (SELECT f, sqrt(avg(power(y - c0 - ca * a - cb * b, 2))) AS rmse_train FROM part JOIN fitted USING (f) GROUP BY f) USING (f)
        JOIN (SELECT f, sqrt(avg(power(y - c0 - ca * a - cb * b, 2))) AS rmse_validation FROM fitted, rows WHERE NOT train GROUP BY f) USING (f))"""


def curve(spark, sf):
    train, test, _ = split_features(spark, sf)
    estimator, used = plain_models()["LeastSquares"]
    return training.learning_curve(train, test, used, LABEL, TIME, estimator=estimator)


@query("learning_curve", f"{_CURVE} SELECT * FROM curve", doubles="train_fraction:2 rmse_train rmse_validation")
def _(spark, sf):
    """Errors on growing prefixes of the training rows and on the test rows."""
    return curve(spark, sf)


@query("curve_optimum", f"""{_CURVE} SELECT train_fraction, train_rows, rmse_validation, rmse_validation - rmse_train AS gap FROM curve
    ORDER BY curve.rmse_validation, train_fraction LIMIT 1""", doubles="train_fraction:2 rmse_validation gap")
def _(spark, sf):
    return regression.curve_optimum(curve(spark, sf))


# The four models of the reference job have no twin in SQL; their figures are checked in tests/test_models.py.
@query("fit_all_models")
def _(spark, sf):
    """All four models fitted, scored and compared."""
    train, test, names = split_features(spark, sf)
    return training.train_and_compare(train, test, names, LABEL, training.model_path(spark)).drop("train_time_s")


@query("learning_curve_forest")
def _(spark, sf):
    train, test, names = split_features(spark, sf)
    return training.learning_curve(train, test, names, LABEL, TIME)
