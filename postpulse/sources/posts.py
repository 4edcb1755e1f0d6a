"""Typed posts stored as Parquet by day: decoded once, read by many queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import POST


def store_posts(
    posts: DataFrame, path: str, checkpoint: str, trigger: str | None = None, files_per_day: int | None = None
) -> StreamingQuery:
    """Adds a stream's posts to the store, each exactly once. Without a trigger
    interval the query stops when the source is drained.

    A micro-batch adds up to ``files_per_day`` files to a day, each written by
    one task: by default as many as the session's shuffles have partitions."""
    if files_per_day is None:
        files_per_day = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = (
        posts.withColumn("day", F.to_date("ts"))
        # A few files per day and batch instead of one for each task.
        .repartition("day", F.pmod(F.xxhash64("id"), F.lit(files_per_day)))
        .writeStream.queryName("store_posts")
        .format("parquet")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def wait_for_folder(storing: StreamingQuery, path: str) -> None:
    """Returns when a store that is being filled can be read."""
    while True:
        storing.awaitTermination(1)
        if storing.exception():
            raise storing.exception()
        if storing.lastProgress is not None:
            try:
                SparkSession.active().read.schema(POST).parquet(path).limit(0).collect()
            except AnalysisException:
                continue
            return


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """Stored posts. A condition on ``day`` skips the other days' folders."""
    return spark.read.schema(f"{POST}, day DATE").parquet(path)


def stream_posts(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stored posts as a stream, for queries that share one decoding."""
    reader = spark.readStream.schema(f"{POST}, day DATE")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
