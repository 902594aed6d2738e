"""Parquet layers partitioned by year and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import TOPIC_RAW, TOPIC_REALTIME
from ..functions.parsing import parse_instant
from ..operators.select import available_columns, union_by_name
from .scratch import path_exists

MEASURE_TOPICS = (TOPIC_RAW, TOPIC_REALTIME)


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "overwrite",
                      dynamic: bool = False, rows_per_file: int = 5_000_000) -> None:
    """Write by partition column.

    AQE balances the pieces before the write (a REBALANCE hint), so a month that holds much
    of the data is split over several tasks and small months are put together.
    """
    (df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
     .option("compression", "snappy").option("maxRecordsPerFile", rows_per_file)
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path))


def with_month(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn("year", F.year(time)).withColumn("month", F.month(time))


def write_bronze(records: DataFrame, path: str, time: str = "datetime", dynamic: bool = False) -> None:
    write_partitioned(with_month(records, time), f"{path}/raw", ["year", "month"], dynamic=dynamic)


def write_calendar(calendar: DataFrame, path: str) -> None:
    write_partitioned(with_month(calendar, "date_parsed"), f"{path}/tempo", ["year", "month"])


def read_bronze(spark: SparkSession, path: str, time: str = "datetime", stream_path: str | None = None,
                topics: Sequence[str] = MEASURE_TOPICS) -> DataFrame:
    """Batch records and, where there are any, streamed ones of the measure topics; columns one side lacks are null.

    A missing folder is looked up, not guessed from a failed read; any other read error is raised.
    Every topic's folder is read on its own, calendar messages never enter. Streamed times are text;
    one that can't be read becomes null.
    """
    streamed = stream_path or f"{path}/streaming"
    parts = [spark.read.parquet(f"{path}/raw")] if path_exists(spark, f"{path}/raw") else []
    folders = [f for f in (f"{streamed}/topic={t}" for t in topics) if path_exists(spark, f)]
    if not folders and stream_path and path_exists(spark, stream_path):
        folders = [stream_path]  # one topic's folder was named
    for folder in folders:
        rows = spark.read.option("basePath", streamed).parquet(folder)
        typed = parse_instant(F.col(time)) if dict(rows.dtypes)[time] == "string" else F.col(time).cast("timestamp")
        parts.append(rows.withColumn(time, typed))
    if not parts:
        raise FileNotFoundError(f"neither batch nor streamed records below {path}")
    return union_by_name(*parts)


def write_silver(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    out = available_columns(df, columns) if columns else df
    write_partitioned(out, path, ["year", "month"])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_gold(daily: DataFrame, monthly: DataFrame, path: str) -> None:
    write_partitioned(daily, f"{path}/daily", ["year", "month"])
    write_partitioned(monthly, f"{path}/monthly", ["year"])
