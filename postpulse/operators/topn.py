"""Top N items per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .metrics import hashtag_count, source_count, word_count

# List lengths of the stored results.
TOP_WORDS, TOP_HASHTAGS, TOP_SOURCES = 7, 10, 6


def top_n(
    counts: DataFrame, item: str, n: int, group: str | tuple[str, ...] = "topic", by: str = "cnt"
) -> DataFrame:
    """The ``n`` largest rows per group, ties by item ascending.

    Spark cuts every input task to ``n`` rows per group before the shuffle, so
    a group's reducer sees ``n`` rows per task, not the group.
    """
    groups = (group,) if isinstance(group, str) else group
    ranked = Window.partitionBy(*groups).orderBy(F.desc(by), F.asc(item))
    return (
        counts.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def top_words_of(words: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    return top_n(words, "word", n).select("word", "topic")


def top_hashtags_of(hashtags: DataFrame, n: int = TOP_HASHTAGS) -> DataFrame:
    return top_n(hashtags, "hashtag", n).select("hashtag", "topic")


def top_sources_of(sources: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    return top_n(sources, "source", n).select("timestamp", "source", "topic", "cnt")


def top_words(posts: DataFrame, n: int = TOP_WORDS) -> DataFrame:
    return top_words_of(word_count(posts, more_than=0), n)


def top_hashtags(posts: DataFrame, n: int = TOP_HASHTAGS) -> DataFrame:
    return top_hashtags_of(hashtag_count(posts, more_than=0), n)


def top_sources(posts: DataFrame, n: int = TOP_SOURCES) -> DataFrame:
    return top_sources_of(source_count(posts, more_than=0), n)


# Per window: item column and counts of the rankings.
WINDOWED = {
    "word": (word_count, TOP_WORDS),
    "hashtag": (hashtag_count, TOP_HASHTAGS),
    "source": (source_count, TOP_SOURCES),
}


def top_of_windows(posts: DataFrame, item: str, window: str, n: int | None = None) -> DataFrame:
    """(window_start, timestamp, item, topic, cnt): the ``n`` most used items of
    each window and topic, of all counts, ties by item ascending. (On a stream:
    ``streaming.stateful.stream_top_of_windows``.)"""
    count, usual = WINDOWED[item]
    counts = count(posts, window, more_than=0)
    return top_n(counts, item, usual if n is None else n, ("window_start", "topic"))
