"""Compare: live windowed metrics against the batch job's results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import compare, metrics
from ..session import stage
from ..sources.baselines import per_window, read_once_per_key, read_stored, stored_windows
from ..streaming.documents import COMPARE_INDEX
from ..streaming.sinks import Output, start_documents
from ..streaming.stateful import stream_difference
from ..streaming.windows import event_time
from .batch import FILES, PERIOD


def load_baselines(
    spark: SparkSession, folder: str, windows: int | None = None
) -> dict[str, DataFrame]:
    """Stored results by metric, one row per key, counts per window. Without a
    number of windows the period that the batch job has stored is taken."""

    def stored(name: str) -> DataFrame:
        return read_stored(spark, f"{folder}/{FILES[name]}", name)

    def once(name: str, keys: list[str], keep: str) -> DataFrame:
        return read_once_per_key(spark, f"{folder}/{FILES[name]}", name, keys, keep)

    if windows is None:
        windows = stored_windows(spark, f"{folder}/{PERIOD}")
    base = {
        "avg_retweets": once("avg_retweets", ["topic"], "last"),
        "avg_length": once("avg_length", ["topic"], "last"),
        "total_count": per_window(once("total_count", ["topic", "tweet_type"], "first"), windows),
        "source": per_window(once("source_topn", ["source", "topic"], "first"), windows),
        "hashtag": stored("hashtag_topn"),
        "word": stored("word_topn"),
    }
    # Stored once more, so that micro-batches do not each repeat this.
    return {metric: stage(rows, f"baseline_{metric}") for metric, rows in base.items()}


def compared(
    posts: DataFrame, base: dict[str, DataFrame], window: str = metrics.WINDOW
) -> dict[str, tuple[DataFrame, list[Output]]]:
    def output(metric, derive) -> Output:
        return metric, COMPARE_INDEX[metric], lambda rows: derive(rows, base[metric])

    return {
        "compare_summary": (
            metrics.topic_summary(posts, window),
            [
                output("total_count", lambda rows, stored: compare.compare_total_count(
                    metrics.total_count_of(rows), stored)),
                output("avg_retweets", lambda rows, stored: compare.compare_avg_retweets(
                    metrics.avg_retweets_of(rows), stored)),
                output("avg_length", lambda rows, stored: compare.compare_avg_length(
                    metrics.avg_length_of(rows), stored)),
            ],
        ),
        "compare_source": (
            metrics.source_count(posts, window), [output("source", compare.compare_source)]
        ),
        "compare_hashtag": (
            metrics.hashtag_count(posts, window, more_than=0),
            [output("hashtag", compare.compare_hashtag)],
        ),
        "compare_word": (
            metrics.word_count(posts, window, more_than=0, among=base["word"]),
            [output("word", compare.compare_word)],
        ),
    }


def compared_in_state(
    posts: DataFrame, base: dict[str, DataFrame], window: str = metrics.WINDOW
) -> dict[str, tuple[DataFrame, list[Output]]]:
    """``compared`` with the four differences from baselines that are loaded
    into state when the job first starts, and not read again: for baselines too
    large to be joined in every micro-batch. Membership stays a join."""
    live = {
        "avg_retweets": (metrics.avg_retweets(posts, window), ["topic"], "retweets"),
        "avg_length": (metrics.avg_length(posts, window), ["topic"], "length"),
        "total_count": (metrics.total_count(posts, window), ["topic", "tweet_type"], "cnt"),
        "source": (metrics.source_count(posts, window), ["source", "topic"], "cnt"),
    }
    found = {
        f"compare_{metric}": (
            stream_difference(rows, base[metric], keys, value),
            [(metric, COMPARE_INDEX[metric], lambda batch: batch)],
        )
        for metric, (rows, keys, value) in live.items()
    }
    joined = compared(posts, base, window)
    return found | {name: joined[name] for name in ("compare_hashtag", "compare_word")}


def run(
    posts: DataFrame,
    baselines: str,
    windows: int | None,
    output: str,
    checkpoint: str,
    window: str = metrics.WINDOW,
    delay: str = "10 seconds",
    time_domain: str = "event",
    trigger: str | None = None,
    partitions: int | None = None,
    closing: str | None = None,
    in_state: bool = False,
) -> list[StreamingQuery]:
    base = load_baselines(posts.sparkSession, baselines, windows)
    timed = event_time(posts, delay, time_domain, closing)
    return [
        start_documents(rows, name, output, checkpoint, outputs, trigger, partitions)
        for name, (rows, outputs) in (compared_in_state if in_state else compared)(timed, base, window).items()
    ]
