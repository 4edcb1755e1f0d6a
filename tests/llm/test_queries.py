"""Queries against their SQL, and the pipeline."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from checks import verify
from postpulse.llm import near_dup, packing
from postpulse.llm.oracle import ORACLE
from postpulse.llm.queries import QUERIES


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = verify.connect(sf_dir).execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert verify._rows(df.columns, df.collect()) == verify._rows(columns, result.fetchall())


def test_chat_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op2_chat_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    rows = docs
    for name, step in corpus_pipeline.STAGES:
        rows = step(spark, rows, sf_dir).cache()
        seen[name] = rows
        if name != names[-1]:
            assert rows.columns == docs.columns
    good = seen["quality rules"]
    clean = labels.filter("quality = 1").join(docs.filter(F.regexp_count("text", F.lit(r"\S+")) >= 20), "doc_id", "left_semi")
    assert clean.join(good, "doc_id", "left_anti").isEmpty()
    unique = seen["near duplicates"]
    classes = near_dup.near_duplicates(good)
    assert unique.count() == classes.select("class_id").distinct().count()
    assert seen["secrets"].count() == unique.count()
    mixed = seen["mixing"]
    assert mixed.join(seen["secrets"], "doc_id", "left_anti").isEmpty()
    copies = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 < copies <= 3
    packed = seen["packing"]
    assert packed.filter("bin IS NOT NULL").groupBy("bin").agg(F.sum("n").alias("n")).filter(
        F.col("n") > packing.CAPACITY
    ).isEmpty()
    again = packed.filter("bin IS NOT NULL").groupBy("bin", "doc_id").agg(F.count("*").alias("n"))
    assert again.filter("n > 1").isEmpty()
    total = mixed.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert packed.agg(F.sum("n")).first()[0] == total


def test_pipeline_stages_keep_columns_of_any_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    names = [
        "size", "target", "spans", "_first", "n_words", "rate", "copies", "source_size", "kept", "word_chars", "_text", "_row",
        "_size", "_source", "_own_size", "char_distance", "base_failed", "cluster", "_copy", "_digest",
    ]
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} "), "doc_id") for name in names})
    rows = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        rows = step(spark, rows, sf_dir).cache()
        assert rows.columns == docs.columns
        assert all(r[name] == f"{name} {r['doc_id']}" for r in rows.collect() for name in names)
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).count() >= rows.count() > 0
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), sf_dir).count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
