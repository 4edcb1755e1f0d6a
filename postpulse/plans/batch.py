"""Batch: all metrics over a folder of raw lines, as CSV results.

The lines are decoded once into a columnar copy; each pass over it then reads
only its own columns. Six passes serve twelve results: five follow from one
topic x type summary, and each ranking from the counts it ranks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.topics import ELECTION_TOPICS, TopicRules
from ..operators import metrics, topn
from ..schema import STORED
from ..session import dropping_staged, stage
from ..sources.raw import parse_limits, parse_posts, read_lines
from ..streaming.sinks import write_csv

# Result names, as the compare and predict jobs look them up.
FILES = {
    "total_count": "totalcount.csv",
    "avg_retweets": "avgretweets.csv",
    "sentiment": "sentiment.csv",
    "hashtag": "hashtag.csv",
    "popular_user": "popularuser.csv",
    "topic_count": "trackterms.csv",
    "source": "sourcecount.csv",
    "word": "wordcount.csv",
    "avg_length": "avgtweet.csv",
    "word_topn": "wordcountTopN.csv",
    "hashtag_topn": "hashtagTopN.csv",
    "source_topn": "sourcecountTopN.csv",
    "type_rollup": "batch.csv",
}

# First and last post of the input, epoch ms.
PERIOD = "period.csv"

# Results bounded by topics, types and N, written as one file.
SMALL = {
    "total_count", "avg_retweets", "sentiment", "topic_count", "avg_length",
    "word_topn", "hashtag_topn", "source_topn", "type_rollup",
}


def results(
    posts: DataFrame,
    lexicon: dict[str, int] | DataFrame,
    words: int = topn.TOP_WORDS,
    hashtags: int = topn.TOP_HASHTAGS,
    sources: int = topn.TOP_SOURCES,
) -> dict[str, DataFrame]:
    """All batch results by metric name, in stored column order."""
    summary = stage(metrics.topic_summary(posts), "summary")
    all_words = stage(metrics.word_count(posts, more_than=0), "words")
    all_tags = stage(metrics.hashtag_count(posts, more_than=0), "hashtags")
    all_apps = stage(metrics.source_count(posts, more_than=0), "sources")
    found = {
        "total_count": metrics.total_count_of(summary),
        "topic_count": metrics.topic_count_of(summary),
        "type_rollup": metrics.type_rollup_of(summary),
        "avg_retweets": metrics.avg_retweets_of(summary),
        "avg_length": metrics.avg_length_of(summary),
        "sentiment": metrics.sentiment_count(posts, lexicon),
        "popular_user": metrics.distinct_users(posts),
        "hashtag": all_tags.filter("cnt > 1"),
        "word": all_words.filter("cnt > 10"),
        "source": all_apps.filter("cnt > 2"),
        "word_topn": topn.top_words_of(all_words, words),
        "hashtag_topn": topn.top_hashtags_of(all_tags, hashtags),
        "source_topn": topn.top_sources_of(all_apps, sources),
    }
    return {name: rows.select(*_columns(name)) for name, rows in found.items()}


def _columns(metric: str) -> list[str]:
    return [field.split()[0] for field in STORED[metric].split(", ")]


def run(
    posts: DataFrame, output: str, lexicon: dict[str, int] | DataFrame, limits: DataFrame | None = None
) -> None:
    """Writes all results of stored posts, the period they cover and, where
    given, the limit notices; what it stages on the way is deleted."""
    spark = posts.sparkSession
    with dropping_staged(spark):
        for metric, rows in results(posts, lexicon).items():
            write_csv(rows, f"{output}/{FILES[metric]}", one_file=metric in SMALL)
        period = posts.agg(F.unix_millis(F.min("ts")), F.unix_millis(F.max("ts")))
        write_csv(period, f"{output}/{PERIOD}", one_file=True)
        if limits is not None:
            write_csv(limits, f"{output}/limits.csv")


def run_lines(
    spark: SparkSession,
    source: str,
    output: str,
    lexicon: dict[str, int] | DataFrame,
    rules: TopicRules = ELECTION_TOPICS,
    select: Callable[[DataFrame], DataFrame] = lambda posts: posts,
) -> None:
    """The same over raw lines. Posts and limit notices are stored from the
    lines first, each pass reading only the lines that begin like one."""
    lines = read_lines(spark, source)
    with dropping_staged(spark):
        posts = stage(select(parse_posts(lines, rules)), "posts")
        run(posts, output, lexicon, parse_limits(lines))
