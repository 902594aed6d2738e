"""Rolling frames from running values, pieces cut by counted rows, filling from one exchange."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadtide.functions.timeaxis import HOUR, SECOND
from loadtide.operators import impute, islands, lookback
from loadtide.operators.cuts import cuts, nested
from loadtide.operators.lookback import Lag, Rolling
from loadtide.operators.running import Frame, with_frames

PLAIN = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}


@pytest.fixture(scope="module")
def uneven(spark):
    """Uneven steps, ties of values, null keys, infinities, NaN, whole numbers and decimals."""
    rnd, rows = random.Random(1), []
    for k in (None, 1, 2):
        t = -5000
        for i in range(300):
            t += rnd.choice([1, 1, 1, 7, 600, 1800, 1800, 5400, 90000])
            v = rnd.choice([None, rnd.gauss(0, 1), rnd.uniform(-1e3, 1e3), 5.0, 5.0, 5.0])
            odd = rnd.choice([1.5, float("nan") if k == 2 and i % 50 == 0 else 2.25, float("inf") if k == 2 and i % 70 == 1 else -3.125])
            rows.append((k, t, v, None if v is None else int(v), odd))
    df = spark.createDataFrame(rows, "k long, s long, v double, i long, o double")
    return df.select("k", F.timestamp_seconds("s").alias("t"), "v", "i", "o", F.col("i").cast("decimal(12,2)").alias("d")).repartition(4).cache()


def _same(got, want, names, by):
    a, b = (x.toPandas().sort_values(by).reset_index(drop=True) for x in (got, want))
    for n in names:
        assert (a[n].isna() == b[n].isna()).all(), n
        exact = n.split("_")[0] in ("min", "max", "count")
        np.testing.assert_allclose(a[n].astype(float), b[n].astype(float), rtol=0 if exact else 1e-11, atol=0 if exact else 1e-9, err_msg=n)


@pytest.mark.parametrize("include", [True, False])
@pytest.mark.parametrize("back", [HOUR, 24 * HOUR])
def test_time_frames(uneven, back, include):
    features = {f"{s}_{c}": Rolling(c, back, s, 3 if c == "d" else 1, include) for c in "viod" for s in PLAIN}
    frame = Window.partitionBy("k").orderBy(F.unix_micros("t")).rangeBetween(-(back - 1), 0 if include else -1)
    want = uneven.select("*", *[F.when(F.count(f.column).over(frame) >= (0 if f.min_count == 1 else 3), PLAIN[f.stat](f.column).over(frame)).alias(n)
                                for n, f in features.items()])
    got = lookback.time_windows(uneven, "t", features, ["k"], chunk=30 * HOUR)
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    _same(got, want, features, ["k", "t"])


@pytest.mark.parametrize("rows", [1, 7, 100])
def test_row_frames(uneven, rows):
    features = {f"{s}_{c}": Rolling(c, rows, s) for c in "vi" for s in PLAIN}
    frame = Window.partitionBy("k").orderBy("t").rowsBetween(-rows, 0)
    want = uneven.select("*", *[PLAIN[f.stat](f.column).over(frame).alias(n) for n, f in features.items()])
    _same(lookback.row_windows(uneven, "t", features, ["k"], block=64), want, features, ["k", "t"])


def test_repeated_instants_are_in_each_others_frames(spark):
    df = spark.createDataFrame([(1, 5, 1.0), (1, 5, 2.0), (1, 6, 4.0), (1, 9, None)], "g int, a long, v double")
    frames = {s: Frame("v", 2, s) for s in PLAIN}
    got = {(r.a, r.v): (r.sum, r.min, r.max, r["count"]) for r in with_frames(df, ["g"], "a", frames).collect()}
    assert got == {(5, 1.0): (3.0, 1.0, 2.0, 2), (5, 2.0): (3.0, 1.0, 2.0, 2), (6, 4.0): (7.0, 1.0, 4.0, 3), (9, None): (None, None, None, 0)}


def test_what_left_the_frame_leaves_no_rounding(spark):
    df = spark.sql("SELECT 1 AS g, id AS a, CASE WHEN id < 50 THEN 1e15 + id ELSE 0.1 END AS v FROM range(200)")
    rows = with_frames(df, ["g"], "a", {"m": Frame("v", 10, "mean"), "s": Frame("v", 10, "std")}).filter("a >= 60").collect()
    assert {r.s for r in rows} == {0.0} and max(abs(r.m - 0.1) for r in rows) < 0.1  # the scale follows the greatest value
    calm = spark.sql("SELECT 1 AS g, id AS a, CASE WHEN id < 50 THEN 1e3 + id / 7 ELSE 0.1 END AS v FROM range(200)")
    rows = with_frames(calm, ["g"], "a", {"m": Frame("v", 10, "mean"), "s": Frame("v", 10, "std")}).filter("a >= 60").collect()
    assert {r.s for r in rows} == {0.0} and max(abs(r.m - 0.1) for r in rows) < 1e-12


def test_no_frame_is_walked(uneven):
    features = {s: Rolling("v", 24 * HOUR, s, include_current=False) for s in PLAIN}
    plan = lookback.time_windows(uneven, "t", features, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]*), ", plan, re.I)
    assert frames and {(a, b.strip()) for a, b in frames} <= {("RangeFrame", "unboundedpreceding$()"), ("RowFrame", "unboundedpreceding$()"), ("RowFrame", "1")}


# pieces by counted rows


def test_widths_nest():
    for chunk, least in ((28 * 24 * HOUR, 1), (5 * HOUR, HOUR), (HOUR, HOUR), (7, 3)):
        widths = nested(chunk, least)
        assert widths[-1] == least and widths[0] >= chunk and all(a % b == 0 and a // b <= 64 for a, b in zip(widths, widths[1:]))


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of 6,000 rows in one hour, half of these in one second of it; key 0 holds most."""
    rnd = random.Random(4)
    times = [k * HOUR for k in range(4000)] + [50 * HOUR + 7 + k * 3_600_000 for k in range(1, 1000)] + [50 * HOUR + 77 + k * 900 for k in range(1, 1000)]
    rows = [(0 if k % 4 else None, t, float(rnd.randint(0, 5)) if rnd.random() > 0.4 else None) for k, t in enumerate(times)]
    return spark.createDataFrame(rows, "k int, u long, v double").select("k", F.timestamp_micros("u").alias("t"), "v").repartition(4).cache()


def test_pieces_hold_few_rows(crowded):
    where = cuts(crowded, "t", ["k"], 28 * 24 * HOUR, 60)
    assert len(where.crowded) >= 3 and not where.full
    placed = where.place(crowded, F.unix_micros("t"), "at")
    assert placed.count() == crowded.count()
    assert placed.groupBy("k", "at").count().agg(F.max("count")).first()[0] <= 60
    # pieces follow each other: their starts and rows are in one order
    order = Window.partitionBy("k").orderBy("t")
    assert placed.select((F.lag("at").over(order) > F.col("at")).alias("back")).filter("back").isEmpty()
    assert cuts(crowded, "t", ["k"], 28 * 24 * HOUR, 60, least=HOUR).full
    assert not cuts(crowded, "t", ["k"], 28 * 24 * HOUR).crowded


@pytest.mark.parametrize("rows", [40, 300])
def test_crowded_series_come_out_the_same(crowded, rows):
    def like(fn):
        got, want = (sorted(map(str, fn(r).collect())) for r in (rows, None))
        assert got == want and want

    like(lambda r: impute.fill_gaps(crowded, "t", ["v"], ["k"], F.year("t"), rows=r))
    like(lambda r: islands.flag_runs(crowded.withColumn("f", F.col("v").isNull()), "t", "f", ["k"], rows=r))
    like(lambda r: islands.steps(crowded, "t", ["k"], rows=r))
    like(lambda r: lookback.time_windows(crowded, "t", {"a": Lag("v", HOUR), "b": Lag("v", 3_600_000), "m": Rolling("v", 2 * HOUR, "max")}, ["k"], rows=r))
    like(lambda r: lookback.time_windows(crowded, "t", {"a": Lag("v", 900), "s": Rolling("v", SECOND, "sum")}, ["k"], rows=r))
    like(lambda r: lookback.row_windows(crowded, "t", {"a": Lag("v", 3)}, ["k"], F.year("t"), rows=r))


def test_lags_of_a_crowd_are_joined_by_instant(crowded):
    out = lookback.time_windows(crowded, "t", {"a": Lag("v", HOUR)}, ["k"], rows=40)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_filling_scans_its_input_once(spark, tmp_path):
    spark.sql("SELECT timestamp_seconds(id * 1800) AS t, id % 7 AS k, CASE WHEN id % 3 = 0 THEN double(id) END AS v, string(id) AS other FROM range(5000)"
              ).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    out = impute.fill_gaps(df, "t", ["v"], ["k"], F.year("t"), rows=None)
    rows = out.collect()
    assert len(rows) == 5000 and sum(r.v is None for r in rows) == 0 and {r.other for r in rows} == set(map(str, range(5000)))
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_filling_leaves_rows_without_a_time(spark):
    df = spark.createDataFrame([(None, None, 1.0), (None, None, None), (None, 5, 2.0), (None, 6, None), ("a", 7, None)], "k string, s long, v double")
    got = impute.fill_gaps(df.withColumn("t", F.timestamp_seconds("s")), "t", ["v"], ["k"]).collect()
    assert sorted(str((r.k, r.s, r.v)) for r in got) == sorted(map(str, [(None, None, 1.0), (None, None, None), (None, 5, 2.0), (None, 6, 2.0), ("a", 7, None)]))
