"""Sinks: raw lines, CSV results and index documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .documents import documents
from .windows import state_settings

# Metric name, index name, and how the metric's rows follow from a batch.
Output = tuple[str, str, Callable[[DataFrame], DataFrame]]


def _start(writer, trigger: str | None) -> StreamingQuery:
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def save_lines(
    lines: DataFrame, path: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Raw lines as text files, each line exactly once. Without a trigger
    interval the query stops when the source is drained."""
    writer = (
        lines.writeStream.queryName("collect")
        .format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, trigger)


def write_csv(rows: DataFrame, path: str, one_file: bool = False) -> None:
    """``;``-separated rows without a header, replacing an earlier result.

    ``one_file`` is for results whose size the topics bound; results that grow
    with words, tags, apps or users keep one file per task. The exchange keeps
    the aggregation before it parallel.
    """
    (rows.repartition(1) if one_file else rows).write.mode("overwrite").option("sep", ";").option(
        "escape", '"'
    ).option("emptyValue", "").csv(path)


def write_documents(root: str, outputs: list[Output]) -> Callable[[DataFrame, int], None]:
    """Batch writer: a folder of JSON documents per index and micro-batch.

    A replayed micro-batch has the same number and replaces its own folder, so
    a restart leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            for metric, index, derive in outputs:
                docs = documents(derive(batch), metric)
                docs.write.mode("overwrite").text(f"{root}/{index}/batch={batch_id:010d}")
        finally:
            batch.unpersist()

    return write


def start_documents(
    rows: DataFrame,
    name: str,
    root: str,
    checkpoint: str,
    outputs: list[Output],
    trigger: str | None = None,
    partitions: int | None = None,
    write: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    writer = (
        rows.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .foreachBatch(write or write_documents(root, outputs))
    )
    with state_settings(rows.sparkSession, partitions):
        return _start(writer, trigger)
