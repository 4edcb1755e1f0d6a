"""Predict: the next window's means, from live windows and stored baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics
from ..session import stage
from ..sources.baselines import read_once_per_key
from ..streaming.documents import PREDICT_INDEX
from ..streaming.sinks import start_documents
from ..streaming.stateful import stream_line, stream_smoothed
from ..streaming.windows import event_time
from .batch import FILES


def predicted(
    posts: DataFrame,
    retweet_seeds: DataFrame,
    length_seeds: DataFrame,
    window: str = metrics.WINDOW,
) -> dict[str, DataFrame]:
    return {
        "avg_retweets": stream_smoothed(
            metrics.avg_retweets(posts, window), retweet_seeds, "retweets"
        ),
        "avg_length": stream_smoothed(metrics.avg_length(posts, window), length_seeds, "length"),
        "retweets_followers": stream_line(metrics.retweets_followers(posts, window)),
    }


def run(
    posts: DataFrame,
    baselines: str,
    output: str,
    checkpoint: str,
    window: str = metrics.WINDOW,
    delay: str = "10 seconds",
    time_domain: str = "event",
    trigger: str | None = None,
    partitions: int | None = None,
    closing: str | None = None,
) -> list[StreamingQuery]:
    spark = posts.sparkSession

    def seeds(name: str) -> DataFrame:
        path = f"{baselines}/{FILES[name]}"
        return stage(read_once_per_key(spark, path, name, ["topic"], "last"), name)

    streams = predicted(
        event_time(posts, delay, time_domain, closing), seeds("avg_retweets"), seeds("avg_length"), window
    )
    return [
        start_documents(
            rows, f"predict_{name}", output, checkpoint,
            [(name, PREDICT_INDEX[name], lambda batch: batch)], trigger, partitions,
        )
        for name, rows in streams.items()
    ]
