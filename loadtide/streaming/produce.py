"""Sending records as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import TOPIC_CALENDAR, TOPIC_RAW, TOPIC_REALTIME
from ..operators.select import union_by_name
from ..sources.files import route
from ..sources.messages import to_messages

TOPIC_OF_ROUTE = {"annual": TOPIC_RAW, "current": TOPIC_REALTIME, "calendar": TOPIC_CALENDAR}


def topic_of(file: str, topics: Mapping[str, str] = TOPIC_OF_ROUTE) -> Column:
    """Topic of a record's file, null for files of no known kind."""
    kind, topic = route(file), F.lit(None).cast("string")
    for name, t in topics.items():
        topic = F.when(kind == name, t).otherwise(topic)
    return topic


def produce_records(measures: DataFrame, calendar: DataFrame | None = None, file: str = "source_file",
                    topics: Mapping[str, str] = TOPIC_OF_ROUTE) -> DataFrame:
    """Messages (topic, key, value, source_file) with the topic chosen by the record's file name.

    Files of no known kind send nothing.
    """
    def messages(df: DataFrame) -> DataFrame:
        topic = topic_of(file, topics)
        return to_messages(df.withColumn("__topic", topic), F.col("__topic")).filter("topic is not null")

    out = messages(measures)
    return out if calendar is None else union_by_name(out, messages(calendar))


def send(messages: DataFrame, target: str, sink: str = "json", options: Mapping[str, str] | None = None) -> None:
    """Write messages to Kafka, or as files where there is no broker."""
    writer = messages.write.format(sink).options(**(options or {}))
    if sink == "kafka":
        writer.save()
    else:
        writer.mode("append").save(target)


def sent_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic."""
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("sent"))


def file_counts(records: DataFrame, file: str = "source_file", topics: Mapping[str, str] = TOPIC_OF_ROUTE) -> DataFrame:
    """Per file: records sent, and records rejected because the file is of no known kind."""
    known = topic_of(file, topics).isNotNull()
    return records.groupBy(file).agg(F.count(F.when(known, 1)).alias("sent"), F.count(F.when(~known, 1)).alias("rejected"))
