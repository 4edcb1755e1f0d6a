"""Stored batch results, read back as baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STORED


def read_stored(
    spark: SparkSession, path: str, metric: str, sep: str = ";", header: bool = False
) -> DataFrame:
    """A stored metric with its declared column order and types."""
    return _stored(spark, path, metric, sep, header).select(*_names(metric))


def _names(metric: str) -> list[str]:
    return [field.split()[0] for field in STORED[metric].split(", ")]


def read_once_per_key(spark: SparkSession, path: str, metric: str, keys: list[str], keep: str) -> DataFrame:
    """A stored metric with one row per key: the ``first`` or ``last`` one, by
    file name, place in the file and row."""
    at = ("file_name", "file_block_start")
    rows = _stored(spark, path, metric).select(
        *_names(metric), F.struct(*[F.col(f"_metadata.{name}") for name in at]).alias("_file")
    )
    return one_per_key(rows, keys, keep)


def _stored(spark: SparkSession, path: str, metric: str, sep: str = ";", header: bool = False) -> DataFrame:
    return (
        spark.read.schema(STORED[metric])
        .option("sep", sep)
        .option("header", header)
        .option("escape", '"')
        .csv(path)
    )


def one_per_key(stored: DataFrame, keys: list[str], keep: str) -> DataFrame:
    """One row per key: the file's ``first`` or ``last`` one.

    Averages are overwritten by later rows, counts are looked up at the first
    match. Rows go by ``_file`` (name and place of the split), where there is
    one, then by an id that grows within a split.
    """
    values = [name for name in stored.columns if name not in [*keys, "_file"]]
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    place = ["_file"] if "_file" in stored.columns else []
    return (
        stored.withColumn("_row", F.struct(*place, F.monotonically_increasing_id()))
        .groupBy(*keys)
        .agg(pick(F.struct(*values), F.col("_row")).alias("_kept"))
        .select(*keys, "_kept.*")
    )


def windows_between(start_ms: int, end_ms: int, window_ms: int = 60_000) -> int:
    """Whole windows in a period, in integer arithmetic."""
    return (end_ms - start_ms) // window_ms


def windows_covered(posts: DataFrame, window_ms: int = 60_000) -> int:
    """Whole windows between the first and the last post."""
    first, last = posts.agg(
        F.unix_millis(F.min("ts")), F.unix_millis(F.max("ts"))
    ).first()
    return windows_between(first, last, window_ms)


def stored_windows(spark: SparkSession, path: str, window_ms: int = 60_000) -> int:
    """Whole windows of the period (first, last; epoch ms) that a batch covered."""
    period = spark.read.schema("first BIGINT, last BIGINT").option("sep", ";").csv(path).first()
    return max(1, windows_between(period["first"], period["last"], window_ms))


def per_window(stored: DataFrame, windows: int) -> DataFrame:
    """Counts of a whole period as truncated counts per window."""
    return stored.withColumn("cnt", F.call_function("div", F.col("cnt"), F.lit(windows)))
