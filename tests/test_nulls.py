"""Null keys and null times: no row lost, no row doubled."""

import pytest
from pyspark.sql import functions as F

from loadtide.functions.timeaxis import HOUR
from loadtide.operators import islands, lookback, order
from loadtide.operators.lookback import Lag, Rolling
from loadtide.sources import layers, publish

ROWS = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 01:00:00", 2.0), (None, "2024-01-01 00:00:00", 3.0),
        (None, "2024-01-01 01:00:00", 4.0), ("a", None, 5.0), (None, None, 6.0)]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))


def by_value(df, column):
    return {r.v: r[column] for r in df.collect()}


def test_time_windows(rows):
    got = lookback.time_windows(rows, "t", {"lag": Lag("v", HOUR), "mean": Rolling("v", 2 * HOUR)}, ["k"])
    assert by_value(got, "lag") == {1.0: None, 2.0: 1.0, 3.0: None, 4.0: 3.0, 5.0: None, 6.0: None}
    assert by_value(got, "mean") == {1.0: 1.0, 2.0: 1.5, 3.0: 3.0, 4.0: 3.5, 5.0: None, 6.0: None}


def test_row_windows(rows):
    got = lookback.row_windows(rows, "t", {"lag": Lag("v", 1)}, ["k"], F.year("t"))
    assert by_value(got, "lag") == {1.0: None, 2.0: 1.0, 3.0: None, 4.0: 3.0, 5.0: None, 6.0: None}


def test_segments_runs_and_steps(rows):
    assert by_value(islands.label_segments(rows, "t", 1800 * 1_000_000, ["k"]), "segment_id") == {
        1.0: 0, 2.0: 1, 3.0: 0, 4.0: 1, 5.0: None, 6.0: None}
    assert islands.gap_split(rows, "t", "v", 1800 * 1_000_000, ["k"]).count() == 6
    runs = islands.flag_runs(rows.withColumn("f", F.col("v") > 0), "t", "f", ["k"])
    assert sorted((r.k or "", r.n) for r in runs.collect()) == [("", 2), ("a", 2)]
    assert [r.step_us for r in islands.steps(rows, "t", ["k"]).collect()] == [HOUR, HOUR]


def test_every_nth(rows):
    assert order.every_nth(rows, "t", step=1).count() == 6
    assert sorted(r.v for r in order.every_nth(rows, "t", step=2, tie_break=["v"]).collect()) == [1.0, 2.0]


def test_replays_with_null_keys(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a", 1), (None, "b", 1), (2, "c", None)], "k int, v string, p int")
    for name, publish_one in (("merge", lambda p: publish.publish_merge(batch, p, ["k"], partition_by=["p"])),
                              ("upsert", lambda p: publish.publish_upsert(batch, p, ["k"], ["p"]))):
        path = str(tmp_path / name)
        for _ in range(3):
            publish_one(path)
        got = spark.read.parquet(path)
        assert sorted((r.k or 0, r.v, r.p or 0) for r in got.collect()) == [(0, "b", 1), (1, "a", 1), (2, "c", 0)]


def test_upsert_over_many_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(400).select("id", (F.col("id") % 200).alias("p"), F.lit("old").alias("v"))
    publish.publish_upsert(rows.coalesce(2), path, ["id"], ["p"])
    publish.publish_upsert(rows.withColumn("v", F.lit("new")).coalesce(2), path, ["id"], ["p"])
    assert spark.read.parquet(path).filter("v = 'new'").count() == 400


def test_bronze_takes_measure_topics_only(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("2024-01-01T00:00:00Z", 1.0, "raw"), ("nonsense", 2.0, "raw")], "datetime string, v double, kafka_topic string").withColumn(
        "run_date", F.lit("2024-01-02").cast("date")).write.partitionBy("run_date").parquet(f"{root}/streaming/topic=raw")
    spark.createDataFrame([("2024-01-01", "BLEU")], "date string, tempo_color string").write.parquet(f"{root}/streaming/topic=calendar")
    got = layers.read_bronze(spark, root)
    assert "tempo_color" not in got.columns and "topic" in got.columns
    assert {r.v: r.datetime is None for r in got.collect()} == {1.0: False, 2.0: True}
    with pytest.raises(FileNotFoundError):
        layers.read_bronze(spark, f"{root}/nowhere")
