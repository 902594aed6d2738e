"""Rank search for bandwidths and density from cells, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadtide.operators import profile, regression


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


@pytest.mark.parametrize("rank", [0, 7, 300])
@pytest.mark.parametrize("shape", ["even", "crowded", "copies", "one"])
def test_nearest_distances(spark, shape, rank):
    rng = np.random.default_rng(3)
    values = {"even": rng.uniform(-5, 5, 2000), "crowded": np.concatenate([[-1e6, 1e6], rng.normal(3, 1e-7, 1500)]),
              "copies": np.repeat([1.0, 1.0 + 2 ** -52, 2.0, 9.0], 200), "one": np.full(400, 7.25)}[shape]
    grid = [values.min() + i * ((values.max() - values.min()) / 49) for i in range(50)]
    got = regression.nearest_distances(frame(spark, values), "v", grid, rank, values.min(), values.max(), cells=16)
    assert got == [float(np.sort(np.abs(values - g))[rank]) for g in grid]


def test_only_open_cells_reach_the_driver(spark):
    """Values beyond the bandwidths are counted once and never again."""
    values = np.arange(20_000) / 7
    got = regression.nearest_distances(frame(spark, values), "v", [100.0], 50, values.min(), values.max())
    assert got == [float(np.sort(np.abs(values - 100))[50])]


@pytest.mark.parametrize("values", ["normal", "far", "copies"])
def test_density(spark, values):
    rng = np.random.default_rng(5)
    v = {"normal": rng.normal(50, 9, 3000), "far": np.concatenate([rng.normal(0, 1, 500), rng.normal(1e4, 1, 500)]), "copies": np.repeat([1.0, 2.0, 30.0], 40)}[values]
    got = profile.kde(frame(spark, v), "v", 150).orderBy("grid_index").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    x = v.min() - 0.5 * np.ptp(v) + np.arange(150) * 2 * np.ptp(v) / 149
    want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r.x for r in got], x, rtol=1e-12)
    np.testing.assert_allclose([r.density for r in got], want, rtol=1e-10, atol=1e-17)


def test_density_costs_cells_not_values(spark):
    plan = profile.kde(spark.range(1000).select(F.col("id").cast("double").alias("v")), "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [" in plan.split("Generate explode", 1)[1].split("Range (0, 1000", 1)[0]  # cells are added up before they meet the grid


def test_density_of_equal_values_is_null(spark):
    assert {r.density for r in profile.kde(frame(spark, [4.0, 4.0]), "v", 9).collect()} == {None}
    assert {r.density for r in profile.kde(frame(spark, [4.0]), "v", 9).collect()} == {None}
    assert profile.kde(frame(spark, []), "v", 9).count() == 0
