"""Reading Latin-1 files that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.fixed import HEADER_LABELS
from loadtide.operators import quality
from loadtide.sources import files, messages, tsv
from loadtide.sources.scratch import fresh_path

from .base import S0, events, mix, orders, query, table

# Headings of the written files, one of them outside the map.
HEADINGS = ("Périmètre", "Nature", "Date", "Heures", "Consommation", "Nucléaire", "Eolien", "Solaire", " Stockage batterie", "Taux de Co2",
            "Code Région")


def write_lines(lines: DataFrame, heading: str, path: str, group: Column) -> None:
    """Text files with a heading, one folder per group, lines ordered by `rank`."""
    (lines.withColumn("g", group).repartition("g").sortWithinPartitions("g", "rank", "line")
     .select("g", F.col("line").alias(heading)).write.partitionBy("g")
     .options(header=True, sep="\u0001", quote="", escape="", encoding="ISO-8859-1", emptyValue="",
              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path))


def number(c: str, missing: str) -> Column:
    """Decimal comma, or a mark for a missing value."""
    return F.coalesce(F.replace(F.format_string("%.6f", c), F.lit("."), F.lit(",")), F.lit(missing))


def measure_lines(spark, sf) -> str:
    """Writes the half-hour mix as measures files, with lines that must be dropped; gives the folder."""
    s = mix(spark, sf)
    day, clock = F.date_format("b30", "yyyy-MM-dd"), F.date_format("b30", "HH:mm")
    row = F.concat_ws("\t", F.lit("France"), F.lit("Données définitives"), day, clock, number("load", "ND"), number("purchase", "ND"),
                      number("view", "-"), number("click", ""), number("signup", "n/a"), number("error", "ND"), F.lit("Île"))
    good = s.select("b30", row.alias("line"), F.lit(1).alias("rank"))
    odd = F.inline(F.array(*[F.struct(F.lit(line).alias("line"), F.lit(rank).alias("rank")) for line, rank in (
        ("  ", 1), ("a\tb", 1), ("France\tx\t\t00:00\t5", 1), ("France\tx\t2024-1-5\t00:00\t5", 1), ("France\tx\tDate\tHeures\t5", 1),
        ("L'exploitant ne pourra être tenu responsable", 2), ("France\tx\t2031-01-01\t00:00\t5", 3))]))
    days = s.groupBy(F.to_date("b30").cast("timestamp").alias("b30")).agg(F.count(F.lit(1)).alias("n")).select("b30", odd)
    path = fresh_path(spark, "measures")
    write_lines(good.unionByName(days), "\t".join(HEADINGS), path, F.date_format("b30", "yyyy-MM-dd"))
    return path


@query("read_tsv_latin1", f"""
    WITH {S0} SELECT 'France' AS perimeter, 'Données définitives' AS nature, b30 AS datetime, load AS consumption_mw, purchase AS nuclear_mw,
        view AS wind_mw, click AS solar_mw, signup AS battery_storage_mw, error AS co2_rate, NULL::DOUBLE AS gas_mw, 'Île' AS "code_région" FROM s0""",
       doubles="consumption_mw nuclear_mw wind_mw solar_mw battery_storage_mw co2_rate gas_mw")
def _(spark, sf):
    """Latin-1 files with decimal commas, missing-value marks, odd lines and a footer, back to typed rows."""
    lines = tsv.read_lines(spark, measure_lines(spark, sf))
    return tsv.read_measures(lines, extra=["code_région"]).select(
        "perimeter", "nature", "datetime", "consumption_mw", "nuclear_mw", "wind_mw", "solar_mw", "battery_storage_mw", "co2_rate",
        "gas_mw", "code_région")


@query("stop_at_marker", f"""
    WITH {S0} SELECT CAST(b30 AS DATE) AS day, count(*) + 5 AS lines, 0 AS after_footer FROM s0 GROUP BY 1""", ints="lines after_footer")
def _(spark, sf):
    """Lines kept per daily file: the footer and what follows it are gone."""
    lines = tsv.read_lines(spark, measure_lines(spark, sf))
    kept = tsv.stop_at_marker(lines, tsv.file_layout(lines, HEADER_LABELS, "ne pourra"))
    day = F.regexp_extract("path", r"g=(\d{4}-\d{2}-\d{2})", 1).cast("date")
    late = F.col("line").contains("2031-01-01") | F.col("line").contains("ne pourra")
    return kept.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("lines"), F.count(F.when(late, 1)).alias("after_footer"))


@query("reject_rows", """
    WITH d AS (SELECT count(DISTINCT CAST(ts AS DATE)) AS n FROM events)
    SELECT unnest(['blank', 'short', 'no_date', 'bad_date', 'repeated_heading']) AS reason, n FROM d""")
def _(spark, sf):
    """Dropped lines by reason: each daily file has one of every kind."""
    lines = tsv.read_lines(spark, measure_lines(spark, sf))
    return tsv.reject_counts(lines).groupBy("reason").agg(F.sum("n").alias("n"))


@query("read_calendar", """
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date, CASE dayofyear(o_orderdate) % 3 WHEN 0 THEN 'BLEU' WHEN 1 THEN 'BLANC'
        ELSE 'VERT' END AS tempo_color, CAST(o_orderdate AS DATE) AS date_parsed FROM orders""")
def _(spark, sf):
    """Two-column calendar files, colours in any case."""
    turn = F.dayofyear("o_orderdate") % 3
    colour = F.when(turn == 0, "bleu").when(turn == 1, " Blanc ").otherwise("VERT")
    days = table(spark, sf, "orders").select(
        "o_orderdate", F.concat_ws("\t", F.date_format("o_orderdate", "yyyy-MM-dd"), colour).alias("line"), F.lit(1).alias("rank")).distinct()
    junk = days.groupBy(F.date_trunc("year", "o_orderdate").alias("o_orderdate")).agg(F.lit("no tab here").alias("line"), F.lit(1).alias("rank"))
    path = fresh_path(spark, "calendar")
    write_lines(days.unionByName(junk), "Date\tType de jour", path, F.year("o_orderdate"))
    return tsv.read_calendar(tsv.read_lines(spark, path)).select("date", "tempo_color", "date_parsed")


@query("invalid_colours", """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, 'VERT' AS colour FROM orders WHERE dayofyear(o_orderdate) % 3 = 2""")
def _(spark, sf):
    turn = F.dayofyear("o_orderdate") % 3
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.when(turn == 0, "BLEU").when(turn == 1, "BLANC")
                                             .otherwise("VERT").alias("colour")).distinct()
    return tsv.invalid_colours(days, ("BLEU", "BLANC", "ROUGE"), "colour")


def name_files(spark, path: str, name) -> str:
    """Gives the single part file of each folder `g=<group>` below `path` the name `name(group)`, all in one folder; gives that folder."""
    jvm = spark.sparkContext._jvm
    root, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}/named")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for folder in [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("g=")]:
        parts = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        for part in parts:
            fs.rename(part, jvm.org.apache.hadoop.fs.Path(target, name(folder.getName().removeprefix("g="))))
    return f"{path}/named"


# Kind and year of an order, as file names; the years of one kind go into files that no route knows.
_ORDER_FILE = "CASE o_orderstatus WHEN 'F' THEN 'x_Annuel-Definitif_' WHEN 'O' THEN 'x_En-cours-TR_' ELSE CASE WHEN year(o_orderdate) % 2 = 0 THEN 'x_tempo_' ELSE 'notes_' END END"


def order_files(spark, sf) -> str:
    group = F.concat(F.expr(_ORDER_FILE), F.year("o_orderdate").cast("string"))
    lines = table(spark, sf, "orders").select(F.concat_ws("\t", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("line"), F.lit(1).alias("rank"),
                                              group.alias("file"))
    path = fresh_path(spark, "orders")
    write_lines(lines, "Clé\tDate", path, F.col("file"))
    # the files of one year end in .txt: the reader's pattern leaves them out
    return name_files(spark, path, lambda g: f"{g}.txt" if g.endswith("1997") else f"{g}.xls")


_FILES = f"""f AS (SELECT {_ORDER_FILE} || year(o_orderdate) || '.xls' AS file_name, o_orderkey FROM orders WHERE year(o_orderdate) <> 1997),
    r AS (SELECT file_name, CASE WHEN file_name LIKE '%tempo%' THEN 'calendar' WHEN file_name LIKE '%Annuel%' THEN 'annual' WHEN file_name LIKE '%En-cours%' THEN 'current' END
        AS route, o_orderkey FROM f)"""


@query("select_files", f"WITH {_FILES} SELECT file_name, route, true AS has_bytes FROM r GROUP BY 1, 2")
def _(spark, sf):
    """The listing of a folder of written files, with routes; a name of no known kind has none, other endings are left out."""
    return files.select_files(spark, order_files(spark, sf)).select("file_name", "route", (F.col("length") > 0).alias("has_bytes"))


@query("read_selected_files", f"""
    WITH {_FILES} SELECT file_name, count(*) + 1 AS n_lines, sum(o_orderkey)::BIGINT AS keys FROM r WHERE route = 'annual' GROUP BY 1""")
def _(spark, sf):
    """Lines of the annual files; the others aren't opened."""
    lines = tsv.read_lines(spark, order_files(spark, sf), glob="*.xls", where=files.is_kind("annual"))
    key = F.split("line", "\t")[0].try_cast("long")
    return lines.groupBy(F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("n_lines"), F.sum(key).alias("keys"))


_NAMED = "CASE WHEN dayofmonth(b30) = 13 THEN 'copie_' ELSE 'mesures_Annuel_' END"


@query("file_inventory", f"""
    WITH {S0} SELECT {_NAMED} || strftime(b30, '%Y-%m-%d') || '.xls' AS source_file, CASE WHEN any_value(dayofmonth(b30)) <> 13 THEN 'annual' END AS route,
        count(*) AS n_rows, min(b30) AS min_time, max(b30) AS max_time, string_agg(DISTINCT year(b30)::VARCHAR, ',') AS years FROM s0 GROUP BY 1""")
def _(spark, sf):
    """Rows, time span and years of each file, by its own name; the files of one day of the month are misnamed."""
    folder = name_files(spark, measure_lines(spark, sf), lambda day: f"{'copie_' if day.endswith('-13') else 'mesures_Annuel_'}{day}.xls")
    inventory = quality.source_inventory(tsv.read_measures(tsv.read_lines(spark, folder, glob="*.xls")))
    return inventory.select("source_file", files.route("source_file").alias("route"), "n_rows", "min_time", "max_time", "years")


FIELDS = [("event_id", "bigint"), ("event_type", "string"), ("value", "double"), ("ts", "timestamp"), ("k", "int")]


@query("export_stream_parquet", """
    SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value, ts, NULL::BIGINT AS k FROM events""", doubles="value")
def _(spark, sf):
    """JSON messages to typed Parquet: unusable and absent values become null, the rest of the row stays."""
    e = table(spark, sf, "events")
    value = F.when(F.col("event_type") == "error", "broken").otherwise(F.col("value").cast("string"))
    text = F.to_json(F.struct("event_id", "event_type", value.alias("value"), F.col("ts").cast("string").alias("ts")))
    path = fresh_path(spark, "export")
    messages.export_parquet(e.select(text.alias("value")), FIELDS, path)
    return spark.read.parquet(path)
