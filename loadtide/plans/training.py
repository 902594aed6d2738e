"""Model jobs: load, split, fit, evaluate, compare, export."""

from __future__ import annotations

import time as clock
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import FEATURE_COLUMNS
from ..functions.measures import all_present
from ..functions.timeaxis import micros
from ..operators.order import select_ranks, time_split
from ..operators.regression import error_metrics
from ..operators.select import available
from ..sources.scratch import fresh_path, materialize


@dataclass(frozen=True)
class ModelSettings:
    # The training parameters.
    train_ratio: float = 0.8
    seed: int = 42
    linear_iterations: int = 20
    linear_reg: float = 0.01
    linear_elastic: float = 0.5
    tree_depth: int = 8
    forest_trees: int = 30
    forest_depth: int = 8
    boost_rounds: int = 30
    boost_depth: int = 6
    curve_fractions: tuple[float, ...] = (0.15, 0.3, 0.5, 0.65, 0.8, 1.0)
    curve_min_rows: int = 500


def load_training(df: DataFrame, label: str = "consumption_mw", lag: str = "lag_24h_mw") -> DataFrame:
    return df.filter(all_present([label, lag]))


def assemble_features(df: DataFrame, candidates: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """The candidate columns that exist as one vector; rows with a null among them are skipped."""
    return assembler(available(df, candidates)).transform(df)


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def split(df: DataFrame, time: str, ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    train, test = time_split(df, time, ratio)
    return materialize(train), materialize(test)


def estimators(label: str, s: ModelSettings = ModelSettings()) -> dict[str, object]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "LinearRegression": LinearRegression(maxIter=s.linear_iterations, regParam=s.linear_reg,
                                             elasticNetParam=s.linear_elastic, **common),
        "DecisionTree": DecisionTreeRegressor(maxDepth=s.tree_depth, seed=s.seed, **common),
        "RandomForest": RandomForestRegressor(numTrees=s.forest_trees, maxDepth=s.forest_depth, seed=s.seed, **common),
        "GradientBoosting": GBTRegressor(maxIter=s.boost_rounds, maxDepth=s.boost_depth, seed=s.seed, **common),
    }


def fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator]).fit(train)


def score(model: PipelineModel, rows: DataFrame, label: str) -> dict[str, float]:
    """RMSE, MAE, MAPE over positive labels and R2 in one pass."""
    row = model.transform(rows).agg(*[m.alias(n) for n, m in error_metrics(label, "prediction").items()]).first()
    return row.asDict()


def plain_estimators(label: str) -> dict[str, object]:
    """Models with one right answer: least squares without a penalty, and a tree of one split."""
    common = {"featuresCol": "features", "labelCol": label}
    return {"LeastSquares": LinearRegression(solver="normal", regParam=0.0, **common), "Stump": DecisionTreeRegressor(maxDepth=1, **common)}


def train_and_compare(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, path: str,
                      settings: ModelSettings = ModelSettings(), models: Mapping[str, tuple[object, Sequence[str]]] | None = None) -> DataFrame:
    """Fit, time, score and save every model; one row per model. `models` gives other estimators, each with its own features."""
    rows = []
    for name, (estimator, used) in (models or {n: (e, features) for n, e in estimators(label, settings).items()}).items():
        started = clock.monotonic()
        model = fit(train, used, estimator)
        seconds = clock.monotonic() - started
        rows.append({"model_name": name, **score(model, test, label), "train_time_s": round(seconds, 2)})
        model.write().overwrite().save(f"{path}/{name}")
    schema = "model_name string, rmse double, mae double, mape_pct double, r2 double, train_time_s double"
    names = [f.split()[0] for f in schema.split(", ")]
    return train.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def select_best(metrics: DataFrame, path: str) -> str:
    """Copy the model with the least error to `best`; gives its name."""
    best = metrics.agg(F.min_by("model_name", F.struct("rmse", "model_name")).alias("m")).first()
    if best.m is None:
        raise ValueError("no trained model to choose from")
    PipelineModel.load(f"{path}/{best.m}").write().overwrite().save(f"{path}/best")
    return best.m


def score_export(model: PipelineModel, rows: DataFrame, time: str, label: str) -> DataFrame:
    return model.transform(rows).select(F.col(time), F.col(label).alias("actual"),
                                        F.col("prediction").alias("predicted")).orderBy(time)


def learning_curve(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, time: str,
                   settings: ModelSettings = ModelSettings(), estimator=None) -> DataFrame:
    """Error of the forest, or of another `estimator`, on growing time prefixes of the training rows and on the test rows.

    `train_rows` is the number of rows really used.
    """
    ready = train.filter(all_present([*features, label]))
    estimator = estimator or estimators(label, settings)["RandomForest"]
    ready = materialize(ready)
    places = [lambda n, f=f: F.greatest(F.floor(n * F.lit(f)), F.least(n, F.lit(settings.curve_min_rows)), F.lit(1)) - 1
              for f in settings.curve_fractions]
    rows = []
    for fraction, last in zip(settings.curve_fractions, select_ranks(ready, micros(time), places)):
        part = ready.filter(F.col(time) <= F.timestamp_micros(F.lit(last).cast("long")))
        model = fit(part, features, estimator)
        rows.append((fraction, part.count(), score(model, part, label)["rmse"], score(model, test, label)["rmse"]))
    return train.sparkSession.createDataFrame(
        rows, "train_fraction double, train_rows bigint, rmse_train double, rmse_validation double")


def split_summary(train: DataFrame, test: DataFrame, time: str) -> DataFrame:
    def bounds(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(f"n_{name}"), F.min(time).alias(f"{name}_start"),
                      F.max(time).alias(f"{name}_end"))

    t = bounds(test, "test").select(F.struct("*")).scalar()
    return bounds(train, "train").withColumn("t", t).select("n_train", "t.n_test", "train_start", "train_end",
                                                            "t.test_start", "t.test_end")


def model_path(spark: SparkSession) -> str:
    return fresh_path(spark, "models")
