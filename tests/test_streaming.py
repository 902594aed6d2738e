"""Streams replayed from files: batch equality, replays, late rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loadtide.streaming import bronze, produce, windows

START = datetime(2024, 1, 1)


def events(spark, n=400):
    return spark.range(n).selectExpr("id", "timestamp_seconds(1704067200 + id * 1800) AS t", "double((id * 37) % 101) AS v")


def run(spark, stream, path, mode):
    windows.drain(stream, f"{path}/checkpoint", lambda b, i: b.write.mode("overwrite").parquet(f"{path}/out/batch={i}"), mode)
    return spark.read.parquet(f"{path}/out").drop("batch")


def test_append_with_a_sentinel_equals_batch(spark, tmp_path):
    df = events(spark)
    sentinel = spark.createDataFrame([(-1, START + timedelta(days=60), 0.0)], df.schema)
    df.repartitionByRange(4, "t").write.parquet(str(tmp_path / "in" / "a"))
    sentinel.write.parquet(str(tmp_path / "in" / "b"))
    batch = windows.stream_daily_rollup(df, "t", "v")
    source = windows.replay_source(spark, str(tmp_path / "in" / "*"), df.schema)
    got = run(spark, windows.stream_daily_rollup(source, "t", "v", "10 days"), str(tmp_path), "append")
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(got.filter(F.col("date") < "2024-02-15")) == key(batch)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    df = events(spark, 96)
    df.filter("id >= 48").write.parquet(str(tmp_path / "in" / "a"))
    source = windows.replay_source(spark, str(tmp_path / "in" / "*"), df.schema)
    out, state = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    dropped = []

    def go():
        q = (windows.stream_daily_rollup(source, "t", "v", "1 hour").writeStream.outputMode("update").option("checkpointLocation", state)
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).trigger(availableNow=True).start())
        q.awaitTermination()
        dropped.append(sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]))

    go()
    df.filter("id < 48").write.parquet(str(tmp_path / "in" / "b"))
    go()
    assert dropped[0] == 0 and dropped[1] > 0


def test_upsert_stream_repeats_safely(spark, tmp_path):
    df = events(spark, 200)
    df.write.parquet(str(tmp_path / "in"))
    source = windows.replay_source(spark, str(tmp_path / "in"), df.schema)
    days = windows.stream_daily_rollup(source, "t", "v").withColumn("month", F.month("date"))
    for state in ("first", "again"):  # a lost checkpoint replays everything
        windows.stream_upsert(days, str(tmp_path / "table"), str(tmp_path / state), ["date"], ["month"], True)
    want = windows.stream_daily_rollup(df, "t", "v")
    got = spark.read.parquet(str(tmp_path / "table")).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_topics_keep_their_schema_and_lineage(spark, tmp_path):
    data = [("realtime", 0, 1, "k", '{"datetime": "2024-01-01T00:00:00+00:00", "consumption_mw": 55239.0, "gas_tac_mw": "x"}'),
            ("calendar", 2, 9, "k", '{"date": "2024-01-01", "tempo_color": "ROUGE"}'), ("other", 0, 0, "k", "{}")]
    spark.createDataFrame(data, bronze.MESSAGE_SCHEMA).write.json(str(tmp_path / "in"))
    bronze.consume_to_bronze(bronze.read_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c"), "2024-01-02")
    r = spark.read.parquet(str(tmp_path / "out" / "topic=realtime")).first()
    assert (r.consumption_mw, r.gas_tac_mw, r.kafka_partition, r.kafka_offset, str(r.run_date)) == (55239.0, None, 0, 1, "2024-01-02")
    c = spark.read.parquet(str(tmp_path / "out" / "topic=calendar")).first()
    assert (c.tempo_color, c.kafka_topic, c.kafka_partition) == ("ROUGE", "calendar", 2)


def test_unknown_files_send_nothing_and_keys_fall_back(spark):
    df = spark.createDataFrame([("a_Annuel.xls", "2024-01-01T00:00:00"), ("notes.xls", "x"), ("b_En-cours.xls", None)], "source_file string, datetime string")
    cal = spark.createDataFrame([("t_tempo.xls", "2024-01-01")], "source_file string, date string")
    got = sorted((r.topic, r.key) for r in produce.produce_records(df, cal).collect())
    assert got == [("calendar", "2024-01-01"), ("raw", "2024-01-01T00:00:00"), ("realtime", "")]
