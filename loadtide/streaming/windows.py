"""Event-time de-duplication, daily windows and idempotent upserts on streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import mean_of
from ..sources.publish import publish_upsert


def stream_dedupe(stream: DataFrame, time: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """Exactly one row per key across replays, remembered for as long as the watermark allows."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_aggregates(time: str, load: str) -> list[Column]:
    """Aggregates of a day that a stream can keep up to date."""
    return [mean_of(load).alias("load_mean"), F.min(load).alias("load_min"), F.max(load).alias("load_max"),
            F.sum(load).alias("load_total"), F.count(F.lit(1)).alias("n"),
            F.max(F.struct(F.col(load), (-F.unix_micros(time)).alias("t"), F.hour(time).alias("hour"))).alias("peak")]


def stream_daily_rollup(stream: DataFrame, time: str, load: str, lateness: str | None = None) -> DataFrame:
    """Tumbling day with its peak. Works on a batch frame too and gives the same rows there."""
    if lateness is not None:
        stream = stream.withWatermark(time, lateness)
    out = stream.groupBy(F.window(time, "1 day").alias("w")).agg(*daily_aggregates(time, load))
    return out.select(F.to_date("w.start").alias("date"), "load_mean", "load_min", "load_max", "load_total", "n",
                      F.col("peak.hour").alias("peak_hour"), F.col(f"peak.{load}").alias("peak_value"))


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "update") -> list:
    """Process everything that is there, batch by batch, and stop; gives the progress of the last batches."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query.recentProgress


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str],
                  partition_by: Sequence[str], partition_from_key: bool = False) -> None:
    """Changed rows of each batch upserted by key; replaying a batch changes nothing."""
    drain(stream, checkpoint, lambda batch, _: publish_upsert(
        batch, path, keys, partition_by, partition_from_key=partition_from_key))


def replay_source(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
