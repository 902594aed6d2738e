"""Streaming jobs over the given events, replayed as files and run until everything is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadtide.functions.timeaxis import DAY, HOUR
from loadtide.operators.dedupe import keep_first
from loadtide.sources.scratch import fresh_path
from loadtide.streaming import bronze, late, produce, windows

from .base import DEC, query, table

FIELDS = [("event_id", "bigint"), ("event_type", "string"), ("value", "double"), ("ts", "timestamp"), ("datetime", "string")]
LATENESS = "60 days"
DAYS = [("date", "string"), ("tempo_color", "string")]


def records(spark, sf):
    """Events as measure records of annual and current files."""
    name = F.when(F.col("event_type").isin("click", "view"), "m_En-cours-TR.xls").otherwise("m_Annuel_2024.xls")
    return table(spark, sf, "events").select(
        "event_id", "event_type", "value", "ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("datetime"), name.alias("source_file"))


def calendar(spark, sf):
    return table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("BLEU").alias("tempo_color"),
                                             F.lit("m_tempo.xls").alias("source_file")).distinct()


@query("produce_records", """
    SELECT CASE WHEN event_type IN ('click', 'view') THEN 'realtime' ELSE 'raw' END AS topic, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ')
        AS key, event_id FROM events UNION ALL SELECT DISTINCT 'calendar', strftime(ts, '%Y-%m-%d'), NULL FROM events""")
def _(spark, sf):
    """Keyed JSON messages, routed to three topics by file name."""
    out = produce.produce_records(records(spark, sf), calendar(spark, sf))
    return out.select("topic", "key", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))


@query("sent_counts", """
    SELECT CASE WHEN event_type IN ('click', 'view') THEN 'realtime' ELSE 'raw' END AS topic, count(*) AS sent FROM events GROUP BY 1
    UNION ALL SELECT 'calendar', count(DISTINCT CAST(ts AS DATE)) FROM events""")
def _(spark, sf):
    return produce.sent_counts(produce.produce_records(records(spark, sf), calendar(spark, sf)))


def landed(spark, sf) -> str:
    """Sends the messages as files, drains them twice into typed tables, and gives the folder."""
    work = fresh_path(spark, "stream")
    bad = records(spark, sf).limit(1).withColumn("datetime", F.lit("not a time")).withColumn("event_id", F.lit(-1).cast("long"))
    sent = produce.produce_records(records(spark, sf).unionByName(bad), calendar(spark, sf))
    placed = sent.select("topic", F.lit(0).alias("partition"), F.xxhash64("value").alias("offset"), "key", "value")
    produce.send(placed, f"{work}/messages")
    topics = {"raw": FIELDS, "realtime": FIELDS, "calendar": DAYS}
    for _ in range(2):
        stream = bronze.read_messages(spark, f"{work}/messages")
        bronze.consume_to_bronze(stream, f"{work}/bronze", f"{work}/checkpoint", "2024-02-01", topics)
    return f"{work}/bronze"


@query("consume_to_bronze", """
    SELECT event_id, event_type, value, ts, CASE WHEN event_type IN ('click', 'view') THEN 'realtime' ELSE 'raw' END AS kafka_topic,
        DATE '2024-02-01' AS run_date FROM events""", doubles="value")
def _(spark, sf):
    """Messages drained into one typed table per topic; draining again finds nothing new."""
    path = landed(spark, sf)
    rows = spark.read.parquet(f"{path}/topic=raw").unionByName(spark.read.parquet(f"{path}/topic=realtime"))
    return rows.filter("event_id >= 0").select("event_id", "event_type", "value", "ts", "kafka_topic", "run_date")


@query("route_by_topic", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date, 'BLEU' AS tempo_color, 'calendar' AS kafka_topic FROM events")
def _(spark, sf):
    """Calendar messages keep their colour: every topic has its own schema."""
    return spark.read.parquet(f"{landed(spark, sf)}/topic=calendar").select("date", "tempo_color", "kafka_topic")


@query("stream_to_silver", f"""
    WITH r AS (SELECT time_bucket(INTERVAL 30 MINUTE, date_trunc('second', ts)) AS b30, date_trunc('second', ts) AS datetime, event_id, {DEC}::DOUBLE AS value FROM events),
    one AS (SELECT datetime, value AS consumption_mw FROM r QUALIFY row_number() OVER (PARTITION BY datetime ORDER BY value, event_id) = 1)
    SELECT datetime, consumption_mw, hour(datetime) AS hour, month(datetime) AS month, consumption_mw IS NULL AS is_interpolated FROM one""",
       doubles="consumption_mw:4", ints="hour month")
def _(spark, sf):
    """Events sent, drained into Bronze, read with the batch reader and cleaned; a text that is no time is dropped as untimed."""
    from loadtide.plans import layers as plans
    from loadtide.sources import layers

    path = landed(spark, sf)
    rows = layers.read_bronze(spark, path, stream_path=path)
    untimed = rows.filter("datetime IS NULL").count()
    if untimed != 1:
        raise ValueError(f"{untimed} records without a time instead of the one sent")
    raw = rows.select("datetime", F.col("value").alias("consumption_mw"), "event_id")
    series = plans.SeriesSpec(low=-1e9, high=1e9, fill=("consumption_mw",), score=("consumption_mw",), renewables=())
    clean = plans.clean(raw, series, priority=["consumption_mw", "event_id"])
    return plans.derive(clean.drop("event_id"), series).select("datetime", "consumption_mw", "hour", "month", "is_interpolated")


@query("file_counts", """
    WITH f AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'm_En-cours-TR.xls' WHEN event_type = 'error' THEN 'notes.txt' ELSE 'm_Annuel_2024.xls' END
        AS source_file FROM events)
    SELECT source_file, count(*) FILTER (source_file <> 'notes.txt') AS sent, count(*) FILTER (source_file = 'notes.txt') AS rejected FROM f GROUP BY 1""")
def _(spark, sf):
    """Sent and rejected records of each file; error events come from a file of no known kind."""
    odd = records(spark, sf).withColumn("source_file", F.when(F.col("event_type") == "error", "notes.txt").otherwise(F.col("source_file")))
    return produce.file_counts(odd)


@query("run_rows", """
    WITH f AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'm_En-cours-TR.xls' WHEN event_type = 'error' THEN 'notes.txt' ELSE 'm_Annuel_2024.xls' END
        AS source_file FROM events),
    c AS (SELECT source_file, count(*) AS n, count(*) FILTER (source_file = 'notes.txt') AS bad FROM f GROUP BY 1)
    SELECT 'run-1' AS run_id, source_file, CASE WHEN bad >= n THEN 'failed' WHEN bad > 0 THEN 'partial' ELSE 'success' END AS status,
        n AS rows_read, n - bad AS rows_written, bad AS rows_errored, TIMESTAMP '2024-02-01 00:00:00' AS started_at FROM c""")
def _(spark, sf):
    """Run records of a sending job, one per file."""
    from loadtide.operators import audit

    odd = records(spark, sf).withColumn("source_file", F.when(F.col("event_type") == "error", "notes.txt").otherwise(F.col("source_file")))
    c = produce.file_counts(odd).select("source_file", (F.col("sent") + F.col("rejected")).alias("rows_read"), F.col("sent").alias("rows_written"),
                                        F.lit(0).alias("rows_skipped"), F.col("rejected").alias("rows_errored"))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    path = fresh_path(spark, "audit")
    audit.run_rows(c, "run-1", "produce", "full", at, at).write.mode("append").parquet(path)
    return spark.read.parquet(path).select("run_id", "source_file", "status", "rows_read", "rows_written", "rows_errored", "started_at")


def doubled(spark, sf) -> tuple[str, object]:
    """Events written twice, as a source that replays itself: two files, each with every event."""
    path = fresh_path(spark, "replay")
    e = table(spark, sf, "events").select("event_id", "ts", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    for _ in range(2):
        e.coalesce(1).write.mode("append").parquet(f"{path}/a")
    return path, e.schema


def out_of_order(spark, sf, path: str):
    """Events in three files of the whole time span each, so that most of the later batches' rows are late; gives the schema."""
    e = table(spark, sf, "events").select("ts", F.col("value").cast("decimal(18,2)").alias("value"), "event_type")
    for kinds in (("click",), ("view",), ("signup", "purchase", "error")):
        e.filter(F.col("event_type").isin(*kinds)).coalesce(1).write.mode("append").parquet(path)
    return e.schema


def collected(spark, stream, path: str, mode: str = "append", keys: tuple[str, ...] = ()):
    """Runs a stream into Parquet until nothing is left, and reads the result; of updated rows the last one of each key."""
    def land(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    windows.drain(stream, f"{path}/checkpoint", land, mode)
    rows = spark.read.parquet(f"{path}/out")
    return (keep_first(rows, list(keys), [-F.col("batch")]) if keys else rows).drop("batch")


def delivered(spark, sf) -> tuple[str, object]:
    """Events in files by arrival: every tenth comes six days late, the others within two. Gives what the gate made of them, and the schema."""
    path = fresh_path(spark, "delivered")
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    e = e.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("arrival", F.expr(ARRIVAL))
    first, last = e.agg(F.min("arrival"), F.max("arrival")).first()
    for k in range(first, last + 1):
        e.filter(F.col("arrival") == k).drop("arrival").coalesce(1).write.mode("append").parquet(f"{path}/a")
    schema = e.drop("arrival").schema
    late.gate(windows.replay_source(spark, f"{path}/a", schema, files_per_trigger=1), "ts", 2 * DAY, path)
    late.close(spark, schema, "ts", path)
    return path, schema


# Number of the file an event comes in: days of its time, later for some, in steps of eight days.
ARRIVAL = "(unix_date(to_date(ts)) + CASE WHEN event_id % 10 = 0 THEN 6 ELSE event_id % 3 END) div 8"
_DELIVERED = f"""
    a AS (SELECT *, (epoch_us(ts) // 86400000000 + CASE WHEN event_id % 10 = 0 THEN 6 ELSE event_id % 3 END) // 8 AS arrival FROM events),
    m AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS mark FROM a GROUP BY arrival),
    d AS (SELECT a.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= mark, false) AS late FROM a JOIN m USING (arrival))"""


@query("stream_dedupe", "SELECT event_id, user_id, ts, value FROM events", doubles="value")
def _(spark, sf):
    """Exactly one row per event though every event comes again, most of them beyond the two days that state remembers."""
    path = fresh_path(spark, "replay")
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    late_half = e.filter("event_id % 2 = 0")
    for rows in (late_half, e, e):
        rows.coalesce(1).write.mode("append").parquet(f"{path}/a")
    late.gate(windows.replay_source(spark, f"{path}/a", e.schema, files_per_trigger=1), "ts", 2 * DAY, path)
    late.close(spark, e.schema, "ts", path)
    return late.stream_dedupe_all(spark, e.schema, "ts", ["event_id"], 2 * DAY, path).select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


_DAYS = f"""SELECT CAST(ts AS DATE) AS date, CAST(sum({DEC}) AS DOUBLE) / count(*) AS load_mean, min(value) AS load_min, max(value) AS load_max,
    sum({DEC})::DOUBLE AS load_total, count(*) AS n, hour(arg_min(ts, (-value, ts))) AS peak_hour, max(value) AS peak_value FROM events GROUP BY 1"""


@query("stream_daily_rollup", _DAYS, doubles="load_mean load_min load_max load_total peak_value")
def _(spark, sf):
    """Daily windows of the whole stream, kept up to date over several batches, equal the daily roll-up of the table."""
    path = fresh_path(spark, "daily")
    stream = windows.replay_source(spark, f"{path}/a", out_of_order(spark, sf, f"{path}/a"), files_per_trigger=1)
    return collected(spark, windows.stream_daily_rollup(stream, "ts", "value", LATENESS), path, "update", ("date",))


@query("stream_daily_append", f"""
    WITH {_DELIVERED}, v AS (SELECT *, {DEC} AS x FROM d WHERE NOT late),
    g AS (SELECT CAST(ts AS DATE) AS date, CAST(sum(x) AS DOUBLE) / count(*) AS load_mean, min(value) AS load_min, max(value) AS load_max,
        sum(x)::DOUBLE AS load_total, count(*) AS n, hour(arg_min(ts, (-value, ts))) AS peak_hour, max(value) AS peak_value FROM v GROUP BY 1),
    l AS (SELECT CAST(ts AS DATE) AS date, count(*) AS late FROM d WHERE late GROUP BY 1)
    SELECT date, load_mean, load_min, load_max, load_total, coalesce(n, 0) AS n, peak_hour, peak_value, coalesce(late, 0) AS late
    FROM g FULL JOIN l USING (date)""", doubles="load_mean load_min load_max load_total peak_value")
def _(spark, sf):
    """Days written once each when the watermark (two days) has passed them, and how many rows came too late for them."""
    path, schema = delivered(spark, sf)
    return late.stream_daily_append(spark, schema, "ts", "value", 2 * DAY, path)


@query("stream_sessions", """
    WITH t AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w > INTERVAL 24 HOUR THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM t)
    SELECT user_id, min(ts) AS segment_start, max(ts) AS segment_end, count(*) AS n FROM s GROUP BY user_id, k""")
def _(spark, sf):
    """The users' segments, closed over several batches in time order."""
    path = fresh_path(spark, "sessions")
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("k", F.expr("unix_date(to_date(ts)) div 6"))
    first, last = e.agg(F.min("k"), F.max("k")).first()
    for k in range(first, last + 1):
        e.filter(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(f"{path}/a")
    late.gate(windows.replay_source(spark, f"{path}/a", e.drop("k").schema, files_per_trigger=1), "ts", DAY, path)
    late.close(spark, e.drop("k").schema, "ts", path)
    return late.stream_sessions(spark, e.drop("k").schema, "ts", 24 * HOUR, ["user_id"], DAY, path)


@query("stream_upsert", _DAYS, doubles="load_mean load_min load_max load_total peak_value")
def _(spark, sf):
    """Days in a table, file by file; state is evicted after two days, and days that get later rows are computed again."""
    path, schema = delivered(spark, sf)
    late.stream_upsert_all(spark, schema, "ts", "value", 2 * DAY, path, f"{path}/table", F.month("date"), "month")
    return spark.read.parquet(f"{path}/table").drop("month")
