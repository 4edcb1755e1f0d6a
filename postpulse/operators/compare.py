"""Live windowed metrics against stored baselines.

Both sides are aggregates: the live side has a row per window and key, the
baseline a row per key, unique (see ``sources.baselines.one_per_key``). No
broadcast is forced. Spark broadcasts a baseline whose file size, or whose
measured shuffle size under adaptive execution, is below its threshold, and
joins by shuffle otherwise. Keys without a baseline yield nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def difference(live: DataFrame, baseline: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Live value minus baseline value, on equal keys."""
    stored = baseline.select(*keys, F.col(value).alias("_stored"))
    return (
        live.join(stored, keys)
        .withColumn(value, F.col(value) - F.col("_stored"))
        .select(*live.columns)
    )


def members(live: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows whose key the baseline lists."""
    return live.join(baseline.select(*keys), keys, "left_semi").select(*live.columns)


def compare_avg_retweets(live: DataFrame, baseline: DataFrame) -> DataFrame:
    return difference(live, baseline, ["topic"], "retweets")


def compare_avg_length(live: DataFrame, baseline: DataFrame) -> DataFrame:
    return difference(live, baseline, ["topic"], "length")


def compare_total_count(live: DataFrame, per_window: DataFrame) -> DataFrame:
    return difference(live, per_window, ["topic", "tweet_type"], "cnt")


def compare_source(live: DataFrame, per_window: DataFrame) -> DataFrame:
    return difference(live, per_window, ["source", "topic"], "cnt")


def compare_hashtag(live: DataFrame, top_hashtags: DataFrame) -> DataFrame:
    return members(live, top_hashtags, ["hashtag", "topic"])


def compare_word(live: DataFrame, top_words: DataFrame) -> DataFrame:
    return members(live, top_words, ["word", "topic"])
