"""Live: ten windowed metrics of a post stream, as index documents.

Six queries serve ten metrics. Five metrics come from one windowed
topic x type summary: all of a window's groups close in the same micro-batch,
so the batch writer sees each window whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics
from ..streaming.documents import LIVE_INDEX
from ..streaming.index import write_bulks
from ..streaming.sinks import Output, start_documents
from ..streaming.stateful import of_width, stream_popular_user, stream_summaries
from ..streaming.windows import event_time


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def _output(metric: str, derive=_as_is) -> Output:
    return metric, LIVE_INDEX[metric], derive


SUMMARY = {
    "total_count": metrics.total_count_of,
    "topic_count": metrics.topic_count_of,
    "avg_retweets": metrics.avg_retweets_of,
    "avg_length": metrics.avg_length_of,
    "retweets_followers": metrics.retweets_followers_of,
}


def _summaries(posts: DataFrame, widths: list[str]) -> tuple[DataFrame, list[Output]]:
    """The summary's metrics in windows of all widths; those of a wider one go
    to indexes named after it."""
    outputs = []
    for width in widths:
        suffix = "" if width == widths[0] else "-" + width.replace(" ", "-")
        for metric, derive in SUMMARY.items():
            outputs.append(
                (metric, LIVE_INDEX[metric] + suffix,
                 lambda rows, derive=derive, width=width: derive(of_width(rows, width)))
            )
    return stream_summaries(posts, widths), outputs


def windowed(
    posts: DataFrame,
    lexicon: dict[str, int],
    window: str = metrics.WINDOW,
    remember: str | None = None,
    wider: list[str] | None = None,
) -> dict[str, tuple[DataFrame, list[Output]]]:
    """Query name to windowed rows and the outputs that follow from them.

    ``remember``: popular users come with the record they were first seen with,
    kept for so long after their last post; else with that of the window.
    ``wider``: widths, multiples of the window's, for which the five metrics of
    the summary are given, too."""
    users = (
        stream_popular_user(posts, window, remember) if remember else metrics.popular_user(posts, window)
    )
    return {
        "summary": (
            _summaries(posts, [window, *wider])
            if wider
            else (
                metrics.topic_summary(posts, window),
                [_output(metric, derive) for metric, derive in SUMMARY.items()],
            )
        ),
        "hashtag": (metrics.hashtag_count(posts, window), [_output("hashtag")]),
        "word": (metrics.word_count(posts, window), [_output("word")]),
        "source": (metrics.source_count(posts, window), [_output("source")]),
        "sentiment": (metrics.sentiment_count(posts, lexicon, window), [_output("sentiment")]),
        "popular_user": (users, [_output("popular_user")]),
    }


def run(
    posts: DataFrame,
    output: str,
    checkpoint: str,
    lexicon: dict[str, int],
    window: str = metrics.WINDOW,
    delay: str = "10 seconds",
    time_domain: str = "event",
    trigger: str | None = None,
    partitions: int | None = None,
    closing: str | None = None,
    remember: str | None = None,
    bulks: bool = False,
    wider: list[str] | None = None,
) -> list[StreamingQuery]:
    """``bulks`` sends the documents in bulks, with ids, to an index store under
    ``output`` (``streaming.index``) instead of to a folder per index."""
    timed = event_time(posts, delay, time_domain, closing)
    return [
        start_documents(
            rows, name, output, checkpoint, outputs, trigger, partitions,
            write_bulks(output, name, outputs) if bulks else None,
        )
        for name, (rows, outputs) in windowed(timed, lexicon, window, remember, wider).items()
    ]
