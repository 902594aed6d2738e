"""JSON messages and the typed Parquet they become."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import MEASURE_COLUMNS, TEXT_COLUMNS

# One schema for files and messages. Values arrive as text so that a bad one costs only itself.
MEASURE_MESSAGE = [*[(c, "string") for c in TEXT_COLUMNS], ("datetime", "string"),
                   *[(c, "double") for c in MEASURE_COLUMNS], ("source_file", "string"), ("ingested_at", "string")]
CALENDAR_MESSAGE = [("date", "string"), ("tempo_color", "string"), ("source_file", "string"), ("ingested_at", "string")]

# Full precision: Spark's own JSON default stops at milliseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_messages(df: DataFrame, topic: str | Column, key: Sequence[str] = ("datetime", "date")) -> DataFrame:
    """Rows as (topic, key, value): the key is the first of the key columns that is set."""
    keys = [F.col(k).cast("string") for k in key if k in df.columns]
    name = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(name.alias("topic"), F.coalesce(*keys, F.lit("")).alias("key"),
                     F.to_json(F.struct(*df.columns), {"timestampFormat": TIMESTAMP_FORMAT}).alias("value"))


def typed_records(messages: DataFrame, fields: Sequence[tuple[str, str]], value: str = "value",
                  lineage: Sequence[str] = ()) -> DataFrame:
    """JSON text into typed columns; a value that does not fit its type becomes null, and so does
    everything in a text that is not JSON."""
    text = T.StructType([T.StructField(n, T.StringType()) for n, _ in fields])
    parsed = messages.withColumn("__r", F.from_json(value, text, {"mode": "PERMISSIVE"}))
    return parsed.select(*[F.col(f"__r.{n}").try_cast(t).alias(n) for n, t in fields], *lineage)


def export_parquet(messages: DataFrame, fields: Sequence[tuple[str, str]], path: str, value: str = "value",
                   lineage: Sequence[str] = ()) -> bool:
    """Write typed messages; no messages, no output. Tells whether anything was written."""
    if messages.isEmpty():
        return False
    typed_records(messages, fields, value, lineage).write.mode("overwrite").parquet(path)
    return True
