"""Registered queries: SQL equality, contracts' columns, and the pipeline against its parts."""

import check
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadtide.llm import line_rules, near_dedup
from loadtide.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert check.compare(spark, check.connect(SMALL), name, SMALL)[0] == "ok"


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_row_has_a_result(spark, name):
    number = int(name[2:].split("_")[0])
    source = {6: "pages", 12: "embeddings", 13: "conversations"}.get(number, "documents")
    rows, found = spark.read.parquet(f"{SMALL}/{source}.parquet"), QUERIES[name](spark, SMALL)
    if number == 11:  # pairs of the sources of a language
        sources = rows.groupBy("lang").agg(F.countDistinct("source").alias("s")).agg(F.sum(F.expr("s * (s - 1)"))).first()[0]
        assert found.filter("part = 'pair'").count() == sources
    elif number == 13:
        assert found.count() == rows.select("conv_id").distinct().count() + 1
    else:
        assert found.count() == rows.count() * (8 if number == 12 else 1)


def test_no_python_in_native_plans(spark):
    for name, fn in QUERIES.items():
        if int(name[2:].split("_")[0]) in (2, 3, 4, 5, 9):
            plan = fn(spark, SMALL)._jdf.queryExecution().toString()
            assert not [w for w in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups") if w in plan], name


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SMALL)
        if number < 4:
            assert after.columns == columns, name
        if number == 0:
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in line_rules.judge(docs).collect() if r.kept}
        if number == 1:
            assert {r.doc_id for r in after.collect()} == {r.doc_id for r in near_dedup.near_duplicates(before, 0.8).collect() if r.kept}
        if number == 2:
            assert after.count() == before.count()
        before = corpus_pipeline.stored(after, "test")
    assert before.count() > 0
    assert corpus_pipeline.run(spark, SMALL).exceptAll(before).isEmpty()
