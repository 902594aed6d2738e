"""Registered queries of this subpackage, the tables they read, and tables written on the way."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import loadtide
from loadtide.sources.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL where SQL can say the same."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet to the shared scratch folder and read back.

    Cuts the lineage in a way that outlives lost executors; used for frames that are narrow
    and read more than once.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which grows with the cluster and the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


_shipped: set[str] = set()


def file_system(uri: str):
    """(Arrow file system, path) of an address; a plain path is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if re.match(r"[a-z0-9]+:/", uri) else f"file://{uri}")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, once, by way of the shared scratch folder."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root, out = Path(loadtide.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    target = fresh_path(spark, "code") + ".zip"
    system, path = file_system(target)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as f:
        f.write(out.getvalue())
    sc.addPyFile(target if re.match(r"[a-z0-9]+:/", target) else f"file://{path}")
    _shipped.add(sc.applicationId)


_held: dict[str, dict] = {}


def held(owner: str, table: dict) -> dict:
    """A table that a Python worker keeps between tasks for an operator."""
    _held[owner] = table
    return table


def claim(owner: str) -> None:
    """Called in a worker at the start of a task: other operators' tables go, so that a worker holds one operator's at a time."""
    for name, table in _held.items():
        if name != owner:
            table.clear()
