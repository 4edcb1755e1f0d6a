"""A corpus pipeline: quality rules, near-dedup, secret scan, mixing, packing.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows that the next stage gets. All but the last keep the columns of
documents. ``run`` applies them to the documents table, each stage written as
Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.llm import mixing, near_dup, packing, quality, secrets
from postpulse.llm.words import shielded, word_count
from postpulse.session import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return shielded(docs, quality.ADDED, lambda rows: quality.quality_rules(rows).filter("kept"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id."""
    return near_dup.keep_first(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts redacted."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""

    def mixed(rows: DataFrame) -> DataFrame:
        return mixing.repeat_copies(mixing.mix(rows.withColumn("size", word_count(F.col("text")))))

    return shielded(docs, ("size", *mixing.ADDED), mixed)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in bins; the copies of a document never share one."""
    sized = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("cluster"), word_count(F.col("text")).alias("size")
    )
    return packing.pack(stage(sized, "pack-sizes"))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_dup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The signatures, the dual values and the packing order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
