"""Chunked operators against plain pandas, with chunks small enough to cut the series everywhere."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadtide.functions.timeaxis import HOUR, MINUTE
from loadtide.operators import dedupe, impute, islands, lookback, order, profile, regression
from loadtide.operators.lookback import Lag, Rolling


@pytest.fixture(scope="module")
def series(spark):
    """Two keys, half-hour grid over a year end, with missing slots and missing values; key 1 holds most rows."""
    rng = np.random.default_rng(7)
    rows = []
    for key, n in ((1, 900), (2, 120)):
        slots = pd.date_range("2023-12-25", periods=n, freq="30min")
        keep = rng.random(n) > 0.12
        keep[300:380] = False
        for t in slots[keep]:
            rows.append((key, t, float(np.round(rng.normal(100, 30), 2)) if rng.random() > 0.3 else None))
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"])
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1), "k int, t timestamp, v double")
    df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return pdf, df.repartition(5).cache()


def sorted_pdf(df, by):
    return df.toPandas().sort_values(by).reset_index(drop=True)


@pytest.mark.parametrize("chunk", [2 * HOUR, 24 * HOUR, 2400 * HOUR])
def test_fill_gaps(series, chunk):
    pdf, df = series
    got = sorted_pdf(impute.fill_gaps(df, "t", ["v"], ["k"], F.year("t"), chunk), ["k", "t"])
    want = pdf.copy()
    want["v"] = want.groupby(["k", want.t.dt.year])["v"].transform(lambda s: s.ffill().bfill())
    np.testing.assert_allclose(got.v.to_numpy(), want.v.to_numpy())


def test_fill_gaps_leaves_an_empty_column(spark):
    df = spark.sql("SELECT timestamp_seconds(id * 1800) AS t, CAST(NULL AS double) AS v FROM range(10)")
    assert impute.fill_gaps(df, "t", ["v"]).filter("v IS NOT NULL").count() == 0


@pytest.mark.parametrize("chunk", [3 * HOUR, 100 * HOUR])
def test_time_windows(series, chunk):
    pdf, df = series
    got = sorted_pdf(lookback.time_windows(df, "t", {
        "lag": Lag("v", 3 * HOUR), "mean": Rolling("v", 6 * HOUR, min_count=3), "before": Rolling("v", 6 * HOUR, "sum", include_current=False),
    }, ["k"], chunk), ["k", "t"])
    for k, g in pdf.groupby("k"):
        mine = got[got.k == k]
        s = g.set_index("t")["v"]
        lag = s.reindex(s.index - pd.Timedelta(hours=3)).to_numpy()
        np.testing.assert_allclose(mine.lag.to_numpy(), lag)
        np.testing.assert_allclose(mine["mean"].to_numpy(), s.rolling("6h", min_periods=3).mean().to_numpy())
        np.testing.assert_allclose(mine.before.to_numpy(), s.rolling("6h", min_periods=1, closed="neither").sum().to_numpy())


@pytest.mark.parametrize("chunk,block", [(5 * HOUR, 60), (2000 * HOUR, 8192)])
def test_row_windows(series, chunk, block):
    pdf, df = series
    got = sorted_pdf(lookback.row_windows(df, "t", {"lag": Lag("v", 48), "mean": Rolling("v", 48), "std": Rolling("v", 48, "std")},
                                          ["k"], F.year("t"), chunk, block), ["k", "t"])
    grouped = pdf.groupby(["k", pdf.t.dt.year])["v"]
    np.testing.assert_allclose(got.lag.to_numpy(), grouped.shift(48).to_numpy())
    np.testing.assert_allclose(got["mean"].to_numpy(), grouped.transform(lambda s: s.rolling(49, min_periods=1).mean()).to_numpy())
    np.testing.assert_allclose(got["std"].to_numpy(), grouped.transform(lambda s: s.rolling(49, min_periods=2).std()).to_numpy())


@pytest.mark.parametrize("per_block", [None, 4])
def test_row_index(series, per_block):
    pdf, df = series
    chunk = lookback.floor_div(lookback.micros("t"), HOUR)
    got = sorted_pdf(lookback.with_row_index(df, ["t"], ["k"], chunk, "i", per_block), ["k", "t"])
    assert got.i.tolist() == pdf.groupby("k").cumcount().tolist()


def test_segments_and_gap_split(series):
    pdf, df = series
    gap = pdf.groupby("k").t.diff() > pd.Timedelta(hours=2)
    seg = gap.groupby(pdf.k).cumsum()
    want = pdf.groupby(["k", seg]).t.agg(["min", "max", "size"]).reset_index()
    got = sorted_pdf(islands.segment_islands(df, "t", 2 * HOUR, ["k"]), ["k", "segment_id"])
    assert got.segment_start.tolist() == want["min"].tolist() and got.segment_end.tolist() == want["max"].tolist()
    assert got.n.tolist() == want["size"].tolist()
    labels = sorted_pdf(islands.label_segments(df, "t", 2 * HOUR, ["k"]), ["k", "t"])
    assert labels.segment_id.tolist() == seg.tolist()
    split = sorted_pdf(islands.gap_split(df, "t", "v", 2 * HOUR, ["k"]), ["k", "t"])
    assert split.after_gap.tolist() == gap.tolist()
    assert split.v[gap].isna().all()


def test_gap_of_exactly_the_limit_does_not_split(spark):
    df = spark.sql("SELECT timestamp_seconds(x) AS t FROM VALUES (0), (86400), (172801) AS v(x)")
    assert islands.segment_islands(df, "t", 24 * HOUR).count() == 2


@pytest.mark.parametrize("chunk", [HOUR, 7 * HOUR, 5000 * HOUR])
def test_flag_runs(series, chunk):
    pdf, df = series
    flagged = df.withColumn("f", F.col("v").isNull())
    got = sorted_pdf(islands.flag_runs(flagged, "t", "f", ["k"], chunk), ["k", "run_start"])
    f = pdf.v.isna()
    run = ((f != f.shift()) | (pdf.k != pdf.k.shift())).cumsum()
    want = pdf.assign(f=f, run=run).groupby("run").agg(k=("k", "first"), f=("f", "first"), a=("t", "min"), b=("t", "max"), n=("t", "size"))
    assert got.run_start.tolist() == want.a.tolist() and got.run_end.tolist() == want.b.tolist()
    assert got.n.tolist() == want.n.tolist() and got.f.tolist() == want.f.tolist()


def test_median_step(series):
    pdf, df = series
    want = pdf.groupby("k").t.diff().median().total_seconds()
    assert islands.median_step(df, "t", ["k"], 5 * HOUR).first().median_step_s == want


def test_select_ranks_with_ties_and_far_values(spark):
    values = [5] * 700 + [-(2**45), -1, 2, 3] + [2**50 + i for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    picks = [0, 3, 4, 400, 703, 704, 753]
    got = order.select_ranks(df, F.col("v"), [lambda n, p=p: F.lit(p) for p in picks])
    assert got == [sorted(values)[p] for p in picks]
    assert order.select_ranks(df.filter("v IS NULL"), F.col("v"), [lambda n: n * 0]) == [None]


def test_time_split_keeps_ties_in_training(spark):
    df = spark.sql("SELECT timestamp_seconds(least(id, 7)) AS t FROM range(10)")
    train, test = order.time_split(df, "t", 0.8)
    assert (train.count(), test.count()) == (10, 0)


def test_every_nth(series):
    pdf, df = series
    one = df.filter("k = 1")
    want = pdf[pdf.k == 1].t.iloc[::7].tolist()
    assert sorted_pdf(order.every_nth(one, "t", step=7, chunk=HOUR, block=10 * HOUR), ["t"]).t.tolist() == want
    n = one.count()
    assert order.every_nth(one, "t", max_points=100).count() == -(-n // (n // 100))


def test_keep_first_does_not_depend_on_partitions(series):
    _, df = series
    copies = df.union(df.withColumn("v", F.col("v") + 1)).union(df)
    pick = lambda d: sorted(map(tuple, dedupe.keep_first(d, ["k", "t"], ["v"]).collect()), key=repr)
    assert pick(copies.repartition(1)) == pick(copies.repartition(13, "v"))
    assert dedupe.keep_first(copies, ["k", "t"], ["v"]).count() == df.count()


def test_loess_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.gamma(2.0, 50.0, 400), 0)  # many equal values, long tail
    y = np.round(3 * x + rng.normal(0, 20, 400), 3)
    got = regression.loess(spark.createDataFrame(pd.DataFrame({"x": x, "y": y})), "x", "y", points=60).toPandas().sort_values("grid_index")
    k = max(int(0.08 * len(x)), 3)
    for g, mine in zip(np.linspace(x.min(), x.max(), 60), got.y):
        d = np.abs(x - g)
        h = max(np.sort(d)[min(k, len(x) - 1)], 1e-9)
        w = np.clip(1 - (d / h) ** 3, 0, 1) ** 3
        if w.sum() < 1e-12:
            continue
        xm, ym = (w * x).sum() / w.sum(), (w * y).sum() / w.sum()
        den = (w * (x - xm) ** 2).sum()
        want = ym if den < 1e-12 else ym + (w * (x - xm) * (y - ym)).sum() / den * (g - xm)
        assert mine == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_loess_of_three_points_is_the_points(spark):
    df = spark.createDataFrame([(2.0, 5.0), (1.0, 4.0), (3.0, 9.0)], "x double, y double")
    assert sorted((r.x, r.y) for r in regression.loess(df, "x", "y").collect()) == [(1.0, 4.0), (2.0, 5.0), (3.0, 9.0)]


def test_kde_integrates_to_one_and_bins_come_close(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"v": rng.normal(100, 15, 3000)}))
    exact = profile.kde(df, "v", 300).toPandas().sort_values("x")
    assert np.trapezoid(exact.density, exact.x) == pytest.approx(1.0, abs=1e-3)
    binned = profile.kde(df, "v", 300, bin_width=0.5).toPandas().sort_values("x")
    assert np.abs(np.interp(exact.x, binned.x, binned.density) - exact.density).max() < 0.02 * exact.density.max()


def test_histogram_needs_enough_rows(spark):
    df = spark.range(20).selectExpr("double(id) AS v")
    assert profile.histogram_density(df, "v").count() == 0
    assert profile.histogram_density(df.union(df), "v", 5).agg(F.sum("n")).first()[0] == 40
