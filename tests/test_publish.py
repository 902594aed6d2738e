"""Publish modes: repeatable, order-free, safe when a batch is wrong or a job dies."""

import pytest
from pyspark.sql import functions as F

from loadtide.sources import publish


def rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()))


def batch(spark, data):
    return spark.createDataFrame(data, "k int, v string, p int")


def test_merge_order_does_not_matter(spark, tmp_path):
    a, b = batch(spark, [(1, "a", 1), (2, "a", 1)]), batch(spark, [(3, "b", 2)])
    for name, order in (("ab", (a, b)), ("ba", (b, a))):
        for x in order:
            publish.publish_merge(x, str(tmp_path / name), ["k"], partition_by=["p"])
    assert rows(spark, str(tmp_path / "ab")) == rows(spark, str(tmp_path / "ba")) == [(1, "a", 1), (2, "a", 1), (3, "b", 2)]


def test_merge_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_merge(batch(spark, [(1, "old", 1)]), path, ["k"], partition_by=["p"])
    publish.publish_merge(batch(spark, [(1, "new", 1), (2, "new", 1)]), path, ["k"], partition_by=["p"])
    assert rows(spark, path) == [(1, "old", 1), (2, "new", 1)]


def test_upsert_updates_inserts_moves_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_upsert(batch(spark, [(1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "a", 3)]), path, ["k"], ["p"])
    for _ in range(2):
        publish.publish_upsert(batch(spark, [(2, "b", 1), (3, "b", 4), (5, "b", 4)]), path, ["k"], ["p"])
        assert rows(spark, path) == [(1, "a", 1), (2, "b", 1), (3, "b", 4), (4, "a", 3), (5, "b", 4)]
    assert not (tmp_path / "t" / "p=2").exists()


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_upsert(batch(spark, [(1, "a", 1), (2, "a", 2)]), path, ["k"], ["p"])
    before = sorted(f.name for f in (tmp_path / "t" / "p=2").iterdir())
    publish.publish_upsert(batch(spark, [(1, "b", 1)]), path, ["k"], ["p"], partition_from_key=True)
    assert sorted(f.name for f in (tmp_path / "t" / "p=2").iterdir()) == before
    assert rows(spark, path) == [(1, "b", 1), (2, "a", 2)]


def test_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_upsert(batch(spark, [(1, "a", 1)]), path, ["k"], ["p"])
    publish.publish_upsert(batch(spark, []), path, ["k"], ["p"])
    assert rows(spark, path) == [(1, "a", 1)]


def test_touch_column(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_upsert(batch(spark, [(1, "a", 1)]), path, ["k"], ["p"], touch="processed_at")
    assert spark.read.parquet(path).filter("processed_at IS NOT NULL").count() == 1


@pytest.mark.parametrize("mode", ["merge", "upsert"])
def test_repeated_or_missing_keys_are_refused(spark, tmp_path, mode):
    run = {"merge": lambda b, k: publish.publish_merge(b, str(tmp_path / "t"), k),
           "upsert": lambda b, k: publish.publish_upsert(b, str(tmp_path / "t"), k, ["p"])}[mode]
    with pytest.raises(ValueError, match="repeat"):
        run(batch(spark, [(1, "a", 1), (1, "b", 1)]), ["k"])
    with pytest.raises(ValueError, match="missing"):
        run(batch(spark, [(1, "a", 1)]), ["other"])


def test_upsert_survives_a_crash_between_staging_and_replacing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish.publish_upsert(batch(spark, [(1, "a", 1), (2, "a", 2)]), path, ["k"], ["p"])

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "write_partitioned", die)
        with pytest.raises(RuntimeError):
            publish.publish_upsert(batch(spark, [(1, "b", 2)]), path, ["k"], ["p"])
    assert rows(spark, path) == [(1, "a", 1), (2, "a", 2)]
    publish.publish_upsert(batch(spark, [(1, "b", 2)]), path, ["k"], ["p"])
    assert rows(spark, path) == [(1, "b", 2), (2, "a", 2)]


def test_overwrite_checks_columns_and_may_read_its_target(spark, tmp_path):
    path = str(tmp_path / "t")
    publish.publish_overwrite(batch(spark, [(1, "a", 1), (2, "a", 1)]), path, ["p"])
    publish.publish_overwrite(spark.read.parquet(path).filter("k = 2"), path, ["p"])
    assert rows(spark, path) == [(2, "a", 1)]
    with pytest.raises(ValueError, match="columns differ"):
        publish.publish_overwrite(batch(spark, [(1, "a", 1)]).drop("v"), path, ["p"])


def test_typed_nulls_and_counts_overflow(spark):
    df = spark.createDataFrame([(999.9994, 12.5), (1000.0, 40000.0), (None, None)], "pct double, n double")
    types = {"pct": (6, 3), "n": "smallint"}
    got = [(None if r.pct is None else float(r.pct), r.n) for r in publish.typed(df, types).collect()]
    assert got == [(999.999, 13), (None, None), (None, None)]
    assert {r.column_name: r.overflowed for r in publish.overflow_counts(df, types).collect()} == {"pct": 1, "n": 1}


def test_upserted_frame_keeps_columns_the_batch_lacks(spark):
    target = spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "k int, v string, extra int")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    got = sorted(map(tuple, publish.upserted(target, new, ["k"]).collect()))
    assert got == [(1, "a", 7), (2, "c", 8), (3, "d", None)]
    assert publish.upserted(target, new, ["k"]).agg(F.count(F.lit(1))).first()[0] == 3
