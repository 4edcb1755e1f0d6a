"""What became of a stream's lines, summed over its micro-batches."""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.raw import LineCounts, parse_limits

log = logging.getLogger(__name__)


class LossLog(StreamingQueryListener):
    """Sums the counts that micro-batches report, and logs each report that
    tells of lost lines. A query that starts again begins at zero: it reports
    what it reads then."""

    def __init__(self, counts: LineCounts) -> None:
        self.counts = counts
        self.sums = dict.fromkeys(LineCounts.FATES, 0)
        self._runs: set[str] = set()
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = self.counts.of(event.progress.observedMetrics)
        if found is None:
            return
        with self._changed:
            self._runs.add(str(event.progress.runId))
            for fate, count in found.items():
                self.sums[fate] += count
        if found["lines"] > found["posts"]:
            log.warning("%s, batch %d: %s", event.progress.name, event.progress.batchId, found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def after(self, query: StreamingQuery, seconds: float = 60) -> dict[str, int]:
        """The sums, when the ended query's last report has come in: reports of
        a query come before the news of its end."""
        with self._changed:
            self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds)
            return dict(self.sums)


@contextmanager
def watching(spark: SparkSession, counts: LineCounts) -> Iterator[LossLog]:
    listener = LossLog(counts)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def as_rows(spark: SparkSession, sums: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(sums.items()), "fate STRING, cnt BIGINT")


def store_limits(lines: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Adds a stream's limit notices to a folder of Parquet files, each exactly
    once. Without a trigger interval the query stops when the source is drained."""
    writer = (
        parse_limits(lines).writeStream.queryName("store_limits").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()
