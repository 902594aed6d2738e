"""From message streams to typed Parquet, one schema per topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import TOPIC_CALENDAR, TOPIC_RAW, TOPIC_REALTIME
from ..sources.layers import write_partitioned
from ..sources.messages import CALENDAR_MESSAGE, MEASURE_MESSAGE, typed_records

MESSAGE_SCHEMA = "topic string, partition int, offset bigint, key string, value string"
LINEAGE = ("kafka_topic", "kafka_partition", "kafka_offset")
FIELDS_OF_TOPIC = {TOPIC_RAW: MEASURE_MESSAGE, TOPIC_REALTIME: MEASURE_MESSAGE, TOPIC_CALENDAR: CALENDAR_MESSAGE}


def read_messages(spark: SparkSession, source: str | None = None, options: Mapping[str, str] | None = None,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Message stream from JSON files below `source`, or from Kafka if there is no path.

    Kafka starts at the earliest offset; after that the checkpoint knows where to go on.
    """
    if source is None:
        raw = (spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**(options or {})).load())
    else:
        reader = spark.readStream.schema(MESSAGE_SCHEMA)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        raw = reader.json(source)
    return raw.select(F.col("topic").alias("kafka_topic"), F.col("partition").cast("int").alias("kafka_partition"),
                      F.col("offset").cast("long").alias("kafka_offset"), F.col("value").cast("string").alias("value"))


def route_by_topic(messages: DataFrame, topic: str, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One topic's messages in its own schema, with where they came from."""
    return typed_records(messages.filter(F.col("kafka_topic") == topic), fields, lineage=LINEAGE)


def consume_to_bronze(messages: DataFrame, path: str, checkpoint: str, run_date: str,
                      fields_of_topic: Mapping[str, Sequence[tuple[str, str]]] = FIELDS_OF_TOPIC) -> None:
    """Drain what is there and stop: each batch goes to `path/topic=<topic>/run_date=.../batch=...`.

    A topic has its own schema, so its folder is read on its own (see `layers.read_bronze`).

    A batch that is replayed after a failure overwrites its own folder, so nothing is doubled.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for topic, fields in fields_of_topic.items():
                rows = route_by_topic(batch, topic, fields).select(
                    "*", F.lit(run_date).cast("date").alias("run_date"), F.lit(batch_id).alias("batch"))
                write_partitioned(rows, f"{path}/topic={topic}", ["run_date", "batch"], dynamic=True)
        finally:
            batch.unpersist()

    query = (messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
