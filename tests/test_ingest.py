"""Files in the shapes the sources come in, written by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadtide.fixed import CALENDAR_COLOURS, HEADER_LABELS, MEASURE_COLUMNS, TEXT_COLUMNS
from loadtide.functions import parsing
from loadtide.operators import quality
from loadtide.plans import layers as plans
from loadtide.sources import files, layers, messages, tsv

HEAD = "Périmètre\tNature\tDate\tHeures\tConsommation\tNucléaire\tTaux de Co2\t Stockage batterie\tNom Inconnu"


def row(date, time, *cells, nature="Données définitives"):
    return "\t".join(["France", nature, date, time, *cells])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    lines = [HEAD, row("2024-01-01", "00:00", "55239", "39886,5", "20", "7", "x y"), "", "short\trow", row("2024-01-01", "00:30", "ND", "-", "n/a", "", "é"),
             row("Date", "Heures", "1", "1", "1", "1", "1"), row("2024-1-1", "01:00", "1", "1", "1", "1", "1"),
             row("", "01:00", "1", "1", "1", "1", "1"), row("2024-01-01", "01:00", "12,5,6", "38086", " 18 ", "0", ""),
             row("2024-01-01", "", "51000", "", "", "", ""), "L'exploitant ne pourra être tenu responsable", row("2024-01-01", "02:00", "1", "1", "1", "1", "1")]
    (d / "m_Annuel-Definitif_2024.xls").write_bytes("\r\n".join(lines).encode("latin-1"))
    # Another column order, fewer columns, a leading empty cell, no footer; one reading of the first file again.
    other = ["Nature\tDate\tHeures\tNucléaire\tConsommation", "\t2024-01-02\t00:00\t100\t200", "Données temps réel\t2024-01-01\t00:00\t1\t2"]
    (d / "m_En-cours-TR.xls").write_bytes(("\n".join(other) + "\n").encode("latin-1"))
    cal = ["Date\tType de jour", "2024-01-01\tbleu", "2024-01-15\t BLANC ", "no tab", "", "2024-02-01\tROUGE", "bad\tVERT"]
    (d / "m_tempo_2024-2025.xls").write_bytes("\n".join(cal).encode("latin-1"))
    return str(d)


@pytest.fixture(scope="module")
def lines(spark, folder):
    return tsv.read_lines(spark, folder, glob="m_[AE]*.xls").cache()


def test_fixed_columns():
    assert len(HEADER_LABELS) == 40 and len(MEASURE_COLUMNS) == 36 and len(TEXT_COLUMNS) == 4


def test_records(lines):
    got = [r for r in tsv.read_measures(lines, extra=["nom_inconnu"]).collect() if r.source_file.startswith("m_A")]
    first = next(r for r in got if r.consumption_mw == 55239.0)
    assert (first.perimeter, first.nature, first.nuclear_mw, first.battery_storage_mw, first.nom_inconnu) == (
        "France", "Données définitives", 39886.5, 7.0, "x y")
    second = next(r for r in got if r.datetime == datetime(2024, 1, 1, 0, 30))
    assert (second.consumption_mw, second.nuclear_mw, second.co2_rate, second.battery_storage_mw, second.nom_inconnu) == (None, None, None, None, "é")
    third = next(r for r in got if r.datetime == datetime(2024, 1, 1, 1, 0))
    assert (third.consumption_mw, third.nuclear_mw, third.co2_rate, third.gas_mw) == (None, 38086.0, 18.0, None)
    assert sorted(r.consumption_mw or 0 for r in got if r.datetime == datetime(2024, 1, 1)) == [51000.0, 55239.0]
    assert len(got) == 4


def test_file_with_its_own_layout_and_leading_empty_cell(lines):
    got = {r.datetime: r for r in tsv.read_measures(lines).collect() if r.source_file.startswith("m_E")}
    r = got[datetime(2024, 1, 2)]
    assert (r.nature, r.nuclear_mw, r.consumption_mw, r.perimeter) == (None, 100.0, 200.0, None)


def test_rejects(lines):
    got = {r.reason: r.n for r in tsv.reject_counts(lines).collect()}
    assert got == {"blank": 1, "short": 1, "repeated_heading": 1, "bad_date": 1, "no_date": 1}


def test_a_file_read_in_many_splits(spark, tmp_path):
    body = [row("2024-01-01", f"{i // 60 % 24:02d}:{i % 60:02d}", str(i), "1", "1", "1", "é" * 20) for i in range(5000)]
    cut = body[:4000] + ["ne pourra"] + body[4000:]
    (tmp_path / "big.xls").write_bytes("\n".join([HEAD, *cut]).encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = tsv.read_lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 10
        records = tsv.read_measures(lines)
        assert records.count() == 4000
        assert records.agg(F.max("consumption_mw")).first()[0] == 3999.0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_calendar(spark, folder):
    cal = tsv.read_calendar(tsv.read_lines(spark, folder, glob="*tempo*.xls"))
    got = sorted((r.date, r.tempo_color, str(r.date_parsed)) for r in cal.collect())
    assert got == [("2024-01-01", "BLEU", "2024-01-01"), ("2024-01-15", "BLANC", "2024-01-15"), ("2024-02-01", "ROUGE", "2024-02-01"),
                   ("bad", "VERT", "None")]
    assert [r.tempo_color for r in tsv.invalid_colours(cal, CALENDAR_COLOURS).collect()] == ["VERT"]


def test_select_files(spark, folder):
    got = {r.file_name: r.route for r in files.select_files(spark, folder).collect()}
    assert got == {"m_Annuel-Definitif_2024.xls": "annual", "m_En-cours-TR.xls": "current", "m_tempo_2024-2025.xls": "calendar"}
    assert files.select_files(spark, folder, kind="calendar").count() == 1


def test_inventory(spark, lines, folder):
    records = tsv.read_measures(lines)
    inv = {r.source_file[:3]: (r.n_rows, r.years) for r in quality.source_inventory(records).collect()}
    assert inv == {"m_A": (4, "2024"), "m_E": (2, "2024")}
    cal = tsv.read_calendar(tsv.read_lines(spark, folder, glob="*tempo*.xls")).select(F.col("date_parsed").alias("date"))
    v = quality.source_verdict(records, cal).first()
    assert (v.years_covered, v.year_gaps, v.calendar_only_years, v.passed) == ("2024", "", "", True)


@pytest.mark.parametrize("years,gaps", [([2023, 2024, 2025], []), ([2024], []), ([2024, 2026], [2025]), ([], [])])
def test_year_gaps(spark, years, gaps):
    df = spark.createDataFrame([(datetime(y, 5, 1),) for y in years], "t timestamp")
    assert [r.year for r in quality.year_gaps(df, "t").collect()] == gaps
    v = quality.source_verdict(df, df.select(F.col("t").alias("date")), "t").first()
    assert v.passed == (bool(years) and not gaps)
    assert v.year_gaps == ",".join(map(str, gaps))


def test_settled_data_wins_over_provisional(spark, lines):
    kept = plans.clean(tsv.read_measures(lines).filter("consumption_mw <> 51000 OR consumption_mw IS NULL"), plans.SeriesSpec(low=0, high=1e6))
    r = kept.filter(F.col("datetime") == F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(x.nature, x.consumption_mw) for x in r] == [("Données définitives", 55239.0)]


def test_event_time_in_another_zone(spark):
    df = spark.createDataFrame([("2024-01-15", "12:00"), ("2024-07-15", "12:00"), ("2024-10-27", "02:30"), ("2024-13-01", "00:00"), ("2024-02-01", None)],
                               "d string, t string")
    read = lambda: [r.x for r in df.select(parsing.event_time("d", "t", "Europe/Paris").cast("timestamp_ntz").alias("x")).collect()]
    got = read()
    assert got == [datetime(2024, 1, 15, 11), datetime(2024, 7, 15, 10), datetime(2024, 10, 27, 0, 30), None, datetime(2024, 1, 31, 23)]


def test_session_zone_does_not_move_times(spark):
    df = spark.createDataFrame([("2024-03-31", "02:30")], "d string, t string").select(F.unix_micros(parsing.event_time("d", "t")).alias("x"))
    want = df.first().x
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert df.select("x").first().x == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_read_bronze_with_and_without_stream(spark, tmp_path):
    base = str(tmp_path / "bronze")
    batch = spark.createDataFrame([(datetime(2024, 1, 1), 1.0)], "datetime timestamp, consumption_mw double")
    layers.write_bronze(batch, base)
    assert layers.read_bronze(spark, base).count() == 1
    spark.createDataFrame([("2024-01-02T00:00:00+00:00", 5)], "datetime string, kafka_offset bigint").write.parquet(f"{base}/streaming/raw")
    got = {r.datetime: r for r in layers.read_bronze(spark, base, stream_path=f"{base}/streaming/raw").collect()}
    assert got[datetime(2024, 1, 2)].kafka_offset == 5 and got[datetime(2024, 1, 2)].consumption_mw is None
    assert got[datetime(2024, 1, 1)].year == 2024


def test_messages_keep_the_good_part_of_a_bad_row(spark):
    df = spark.createDataFrame([('{"a": "x", "n": "12,5", "d": 3.5}',), ("not json",), ('{"a": null}',)], "value string")
    got = messages.typed_records(df, [("a", "string"), ("n", "int"), ("d", "double"), ("z", "string")]).collect()
    assert [tuple(r) for r in got] == [("x", None, 3.5, None), (None,) * 4, (None,) * 4]


def test_no_messages_no_output(spark, tmp_path):
    df = spark.createDataFrame([], "value string")
    assert not messages.export_parquet(df, messages.MEASURE_MESSAGE, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_message_schema_has_every_measure():
    assert set(MEASURE_COLUMNS) <= {n for n, _ in messages.MEASURE_MESSAGE}
