"""Choosing input files by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeaxis import col

# What the names of annual, current and calendar files contain.
ROUTES = {"calendar": "tempo", "annual": "annuel", "current": "en-cours"}


def route(name: str | Column, routes: Mapping[str, str] = ROUTES) -> Column:
    """Kind of a file from its name; the first pattern found wins, null if none is."""
    n = F.lower(col(name))
    chosen = F.lit(None).cast("string")
    for kind, pattern in reversed(routes.items()):
        chosen = F.when(n.rlike(pattern), F.lit(kind)).otherwise(chosen)
    return chosen


def select_files(spark: SparkSession, folder: str, glob: str = "*.xls", routes: Mapping[str, str] = ROUTES,
                 kind: str | None = None) -> DataFrame:
    """Files below a folder with their route and size; only the listing is read, not the content."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(folder).select("path", "length"))
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    out = named.select("path", "file_name", route("file_name", routes).alias("route"), "length")
    return out if kind is None else out.filter(F.col("route") == kind)


def is_kind(kind: str, routes: Mapping[str, str] = ROUTES) -> Callable[[Column], Column]:
    """A test of file names for `tsv.read_lines`, which leaves files of other kinds unread."""
    return lambda name: route(name, routes) == kind
