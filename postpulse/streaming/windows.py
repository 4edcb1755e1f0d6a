"""Event time for streams, and running a stream to the end of its input."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import ARRIVAL
from ..session import ROCKSDB_STATE, scratch_path

# Later than any post: a row of this time closes all windows.
END_OF_TIME = dt.datetime(9000, 1, 1, tzinfo=dt.timezone.utc)


def event_time(
    posts: DataFrame, delay: str = "0 seconds", time_domain: str = "event", closing: str | None = None
) -> DataFrame:
    """Posts with a watermark, so that windows close and their state is freed.

    ``event`` uses the post's own time and waits ``delay`` for late ones.
    ``processing`` puts posts into windows by the time of their micro-batch;
    they keep their own time as well. ``closing`` is the folder of
    ``open_ending``: the row that ``end`` puts there closes what is open.
    """
    if time_domain not in ("event", "processing"):
        raise ValueError(f"unknown time domain {time_domain!r}")
    if closing:
        ending = posts.sparkSession.readStream.schema(posts.schema).parquet(closing)
        posts = posts.unionByName(ending)
    if time_domain == "event":
        return posts.withWatermark("ts", delay)
    now = F.greatest(F.current_timestamp(), F.when(F.col("ts") >= F.lit(END_OF_TIME), F.col("ts")))
    return posts.withColumn(ARRIVAL, now).withWatermark(ARRIVAL, delay)


def open_ending(posts: DataFrame, path: str) -> str:
    """An empty folder for the closing row of these posts; kept if it exists."""
    empty = posts.sparkSession.createDataFrame([], posts.schema)
    empty.write.mode("ignore").parquet(path)
    return path


def end(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Declares a stream's input complete: its next run closes all windows, and
    whatever comes after that is late. Nothing is counted for the closing row,
    as its own window never closes."""
    # No nulls: a join that follows drops those before the watermark sees them.
    blank = {
        T.StringType: "", T.BooleanType: False, T.ArrayType: [""],
        T.TimestampType: END_OF_TIME, T.DateType: END_OF_TIME.date(),
    }
    row = tuple(blank.get(type(field.dataType), 0) for field in schema)
    loose = T.StructType([T.StructField(field.name, field.dataType) for field in schema])
    spark.createDataFrame([row], loose).write.mode("append").parquet(path)


def complete(posts: DataFrame) -> DataFrame:
    """A stream that ends with what its source holds now, in event time: one
    run gives all its windows. For sources that aren't read in several batches."""
    path = open_ending(posts, scratch_path(posts.sparkSession, "closing"))
    end(posts.sparkSession, path, posts.schema)
    return event_time(posts, closing=path)


def wait_for(queries: list[StreamingQuery], seconds: float = 1) -> None:
    """Returns when all queries have ended. When one fails, the others are
    stopped, and its error is raised."""
    try:
        while active := [query for query in queries if query.isActive]:
            active[0].awaitTermination(seconds)
            for query in queries:
                if error := query.exception():
                    raise error
        for query in queries:
            if error := query.exception():
                raise error
    except BaseException:
        for query in queries:
            query.stop()
        raise


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stateful query takes over when it starts, and keeps in its
    checkpoint; ``partitions`` overrides the session's shuffle partitions."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def run_to_table(
    rows: DataFrame,
    label: str,
    path: str | None = None,
    checkpoint: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Processes what a stream's source holds now and returns the stored rows.

    Called again with the same folders it goes on from the checkpoint.
    """
    spark = rows.sparkSession
    path = path or scratch_path(spark, label)
    checkpoint = checkpoint or f"{path}-checkpoint"
    with state_settings(spark, partitions):
        query = (
            rows.writeStream.queryName(label)
            .outputMode("append")
            .format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)
