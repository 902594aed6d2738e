"""Latin-1 tab-separated files with a heading row and a footer, read as splittable text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed import DATE_LENGTH, FOOTER_TEXT, HEADER_LABELS, MEASURE_COLUMNS, MIN_CELLS, TEXT_COLUMNS
from ..functions.parsing import event_time, parse_number, parse_text


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1",
               glob: str | None = None, where: Callable[[Column], Column] | None = None) -> DataFrame:
    """Lines with their file and place in it: (source_file, block, seq, line).

    `where` is a test of file names; other files are pruned from the scan.

    Files are split like any text input, so one huge file is read by many tasks. The place is
    the offset of the split and a number that grows inside it. Both follow from how the files are split,
    so every scan of this frame gives a line the same place: heading and footer are looked up in a first scan of
    few columns and rows, the lines are parsed in a second one, and nothing is copied.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(path if isinstance(path, str) else list(path))
    if where is not None:
        text = text.filter(where(F.col("_metadata.file_name")))
    return (text.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
        F.rtrim(F.decode(F.col("value").cast("binary"), encoding), F.lit("\r\n")).alias("line")))


def canonical_name(label: Column, labels: Mapping[str, str]) -> Column:
    """Column name of a heading: from the map, else lower case with underscores."""
    bare = F.trim(label)
    pairs = F.create_map(*[F.lit(x.strip()) if i % 2 == 0 else F.lit(x)
                           for kv in labels.items() for i, x in enumerate(kv)])
    return F.coalesce(F.try_element_at(pairs, bare), F.replace(F.lower(bare), F.lit(" "), F.lit("_")))


def file_layout(lines: DataFrame, labels: Mapping[str, str], footer: str) -> DataFrame:
    """One row per file: place of the heading, place of the footer, and cell number of each column."""
    place = F.struct("block", "seq")
    first = F.min(F.when(F.col("block") == 0, F.struct("block", "seq", "line")))
    found = lines.filter((F.col("block") == 0) | F.col("line").contains(footer))
    per_file = found.groupBy("path").agg(
        first.alias("h"), F.min(F.when(F.col("line").contains(footer), place)).alias("footer"))
    names = F.transform(F.split("h.line", "\t"), lambda x: canonical_name(x, labels))
    cells = F.map_from_entries(F.array_distinct(F.transform(
        names, lambda n: F.struct(n.alias("k"), F.array_position(names, n).cast("int").alias("v")))))
    return per_file.select("path", F.struct("h.block", "h.seq").alias("heading"), "footer", cells.alias("cells"))


def stop_at_marker(lines: DataFrame, layout: DataFrame) -> DataFrame:
    """Lines after the heading and before the first footer line of their file."""
    place = F.struct("block", "seq")
    joined = lines.join(layout, "path")
    return joined.filter((place > F.col("heading")) & (F.col("footer").isNull() | (place < F.col("footer"))))


def reject_reason(cells: Column, date: Column) -> Column:
    """Why a line is not a record, or null if it is one."""
    return (F.when((F.size(cells) == 1) & (F.trim(cells[0]) == ""), "blank")
            .when(F.size(cells) < MIN_CELLS, "short")
            .when(date.isNull(), "no_date")
            .when(date == "Date", "repeated_heading")
            .when(F.length(date) != DATE_LENGTH, "bad_date"))


def _split(lines: DataFrame, labels: Mapping[str, str], footer: str) -> DataFrame:
    body = stop_at_marker(lines, file_layout(lines, labels, footer))
    body = body.withColumn("v", F.split("line", "\t"))
    date = parse_text(cell("date"))
    return body.withColumn("reason", reject_reason(F.col("v"), date))


def cell(name: str) -> Column:
    """Text of a named column in the line's own file layout, or null."""
    return F.try_element_at(F.col("v"), F.try_element_at(F.col("cells"), F.lit(name)))


def read_measures(lines: DataFrame, labels: Mapping[str, str] = HEADER_LABELS,
                  text: Sequence[str] = TEXT_COLUMNS, numbers: Sequence[str] = MEASURE_COLUMNS,
                  footer: str = FOOTER_TEXT, source_tz: str = "UTC", extra: Iterable[str] = ()) -> DataFrame:
    """Typed records of measures files, with a declared schema; columns a file lacks are null.

    `extra` names columns outside the map (lower case, underscores) to keep as text.
    """
    records = _split(lines, labels, footer).filter("reason is null")
    date, clock = parse_text(cell("date")), parse_text(cell("time"))
    return records.select(
        "source_file", event_time(date, clock, source_tz).alias("datetime"),
        *[parse_text(cell(c)).alias(c) for c in text], *[parse_number(cell(c)).alias(c) for c in numbers],
        *[parse_text(cell(c)).alias(c) for c in extra])


def reject_counts(lines: DataFrame, labels: Mapping[str, str] = HEADER_LABELS, footer: str = FOOTER_TEXT) -> DataFrame:
    """Dropped lines per file and reason."""
    return (_split(lines, labels, footer).filter("reason is not null")
            .groupBy("source_file", "reason").agg(F.count(F.lit(1)).alias("n")))


def read_calendar(lines: DataFrame, footer: str = FOOTER_TEXT) -> DataFrame:
    """Day and colour from two-column calendar files: (date, tempo_color, source_file, date_parsed)."""
    place = F.struct("block", "seq")
    heading = lines.groupBy("path").agg(F.min(place).alias("heading"))
    rows = lines.join(heading, "path").filter((place > F.col("heading")) & F.col("line").contains("\t"))
    v = F.split("line", "\t")
    date = F.trim(v[0])
    return rows.filter(~F.col("line").contains(footer)).select(
        date.alias("date"), F.upper(F.trim(v[1])).alias("tempo_color"), "source_file",
        F.try_to_timestamp(date, F.lit("yyyy-MM-dd")).cast("date").alias("date_parsed"))


def invalid_colours(calendar: DataFrame, colours: Sequence[str], column: str = "tempo_color") -> DataFrame:
    return calendar.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(colours)))
