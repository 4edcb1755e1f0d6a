"""Collect: store a live stream's raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..streaming.sinks import save_lines


def run(lines: DataFrame, output: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    return save_lines(lines, output, checkpoint, trigger)
