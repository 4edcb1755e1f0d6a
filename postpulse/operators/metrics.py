"""The metrics. Each is defined once and takes an optional tumbling window.

Without ``window`` a metric covers the whole input. With one (``"60 seconds"``)
it covers each window apart and adds ``window_start``; on a stream the input
needs a watermark on ``ts``. ``timestamp`` (epoch ms) is the earliest post of
the group for counts, and the window's end for windowed means.

Every aggregate here has a map-side partial form, so a topic that holds most
of the posts costs its reducer one row per input task, not one per post.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import millis, truncated_mean
from ..functions.text import hashtag, is_counted_word, source_apps, tokens, utf16_length
from ..schema import ARRIVAL, ORIGINAL, RETWEET
from .closed_words import closed_word_count, listed
from .sentiment import MAX_INLINE_WORDS, sentiment_by_join, stream_sentiment_by_join, with_sentiment

WINDOW = "60 seconds"
# Before any post.
LONG_AGO = "0001-01-01 00:00:00"


def _times(rows: DataFrame) -> list[str]:
    """The post's time and, where windows go by arrival, that."""
    return ["ts", ARRIVAL] if ARRIVAL in rows.columns else ["ts"]


def _only(rows: DataFrame, condition: Column, seen: Column) -> DataFrame:
    """Rows that meet a condition. On a stream the condition is tied to ``seen``
    (true for every row, but unknown to the optimizer): it stays above the
    watermark, so windows also close by posts that the metric leaves out."""
    return rows.filter(F.when(seen, condition) if rows.isStreaming else condition)


def _seen(rows: DataFrame, items: Column) -> Column:
    """Items to explode. On a stream they are tied to the post's time, so that
    the filter on empty ones stays above the watermark, too."""
    if not rows.isStreaming:
        return items
    return F.when(F.col(_times(rows)[-1]) > F.lit(LONG_AGO).cast("timestamp"), items)


def _aggregate(rows: DataFrame, window: str | None, keys: list[str], *aggs: Column) -> DataFrame:
    if window is None:
        return rows.groupBy(*keys).agg(*aggs)
    clock = _times(rows)[-1]
    grouped = rows.groupBy(F.window(clock, window).alias("_window"), *keys).agg(*aggs)
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *[F.col(name) for name in grouped.columns if name != "_window"],
    )


def _lead(rows: DataFrame) -> list[str]:
    return [name for name in ("window_start", "window_end") if name in rows.columns]


def count_by(rows: DataFrame, window: str | None, keys: list[str]) -> DataFrame:
    """Posts per key with the earliest time, the shape of all count metrics."""
    counted = _aggregate(
        rows, window, keys, F.min("ts").alias("_first"), F.count(F.lit(1)).alias("cnt")
    )
    return counted.select(
        *[name for name in _lead(counted) if name != "window_end"],
        millis(F.col("_first")).alias("timestamp"),
        *keys,
        "cnt",
    )


# --- topic x type summary -------------------------------------------------


def topic_summary(posts: DataFrame, window: str | None = None) -> DataFrame:
    """One row per topic and post type with all the sums five metrics need.

    Jobs aggregate the posts once into this small table and derive the five
    from it; unused sums are pruned when only one metric is asked for.
    """
    columns = set(posts.columns)
    aggs = [F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("posts")]
    if "retweet_num_retweets" in columns:
        aggs += [
            F.sum("retweet_num_retweets").alias("retweets"),
            F.sum("retweet_followers").alias("author_followers"),
        ]
    if "text" in columns:
        filled = F.col("text") != ""
        aggs += [
            F.min(F.when(filled, F.col("ts"))).alias("first_text_ts"),
            F.count(F.when(filled, True)).alias("texts"),
            F.sum(F.when(filled, utf16_length(F.col("text")))).alias("text_length"),
        ]
    return _aggregate(posts, window, ["topic", "tweet_type"], *aggs)


def whole_of(summary: DataFrame) -> DataFrame:
    """The summary of all windows together, from the summary per window."""
    merge = {"first_ts": F.min, "first_text_ts": F.min}
    sums = [name for name in summary.columns if name not in ("window_start", "window_end")]
    keys = ["topic", "tweet_type"]
    return summary.groupBy(*keys).agg(
        *[merge.get(name, F.sum)(name).alias(name) for name in sums if name not in keys]
    )


def total_count_of(summary: DataFrame) -> DataFrame:
    return summary.select(
        *_starts(summary), millis(F.col("first_ts")).alias("timestamp"), "topic", "tweet_type",
        F.col("posts").alias("cnt"),
    )


def topic_count_of(summary: DataFrame) -> DataFrame:
    keys = [*_starts(summary), "topic"]
    merged = summary.groupBy(*keys).agg(F.min("first_ts").alias("_first"), F.sum("posts").alias("cnt"))
    return merged.select(
        *_starts(summary), millis(F.col("_first")).alias("timestamp"), "topic", "cnt"
    )


def type_rollup_of(summary: DataFrame) -> DataFrame:
    merged = summary.groupBy("tweet_type").agg(
        F.min("first_ts").alias("_first"), F.sum("posts").alias("cnt")
    )
    return merged.select(
        F.lit("tweetType").alias("name_id"), millis(F.col("_first")).alias("timestamp"),
        "tweet_type", "cnt",
    )


def avg_retweets_of(summary: DataFrame) -> DataFrame:
    """Whole input: truncated INT. Per window: the exact DOUBLE mean."""
    rows = _only(summary, F.col("tweet_type") == RETWEET, F.col("posts") > 0)
    if _starts(summary):
        mean = F.col("retweets") / F.col("posts")
    else:
        mean = truncated_mean(F.col("retweets"), F.col("posts"))
    return rows.select(
        *_starts(summary), _stamp(summary, "first_ts"), mean.alias("retweets"), "topic",
        F.lit(1).alias("cnt"),
    )


def avg_length_of(summary: DataFrame) -> DataFrame:
    originals = _only(summary, F.col("tweet_type") == ORIGINAL, F.col("posts") > 0)
    rows = originals.filter(F.col("texts") > 0)
    return rows.select(
        *_starts(summary), _stamp(summary, "first_text_ts"),
        truncated_mean(F.col("text_length"), F.col("texts")).alias("length"), "topic",
        F.lit(1).alias("cnt"),
    )


def retweets_followers_of(summary: DataFrame) -> DataFrame:
    """Mean audience of the original authors next to mean re-shares."""
    rows = _only(summary, F.col("tweet_type") == RETWEET, F.col("posts") > 0)
    return rows.select(
        *_starts(summary), _stamp(summary, "first_ts"),
        truncated_mean(F.col("author_followers"), F.col("posts")).cast("bigint").alias("followers"),
        truncated_mean(F.col("retweets"), F.col("posts")).alias("retweets"), "topic",
        F.lit(1).alias("cnt"),
    )


def _starts(summary: DataFrame) -> list[str]:
    return ["window_start"] if "window_start" in summary.columns else []


def _stamp(summary: DataFrame, first: str) -> Column:
    at = "window_end" if "window_end" in summary.columns else first
    return millis(F.col(at)).alias("timestamp")


def total_count(posts: DataFrame, window: str | None = None) -> DataFrame:
    return total_count_of(topic_summary(posts, window))


def topic_count(posts: DataFrame, window: str | None = None) -> DataFrame:
    return count_by(posts, window, ["topic"])


def type_rollup(posts: DataFrame) -> DataFrame:
    return type_rollup_of(topic_summary(posts))


def avg_retweets(posts: DataFrame, window: str | None = None) -> DataFrame:
    return avg_retweets_of(topic_summary(posts, window))


def avg_length(posts: DataFrame, window: str | None = None) -> DataFrame:
    return avg_length_of(topic_summary(posts, window))


def retweets_followers(posts: DataFrame, window: str | None = None) -> DataFrame:
    return retweets_followers_of(topic_summary(posts, window))


# --- counts of things inside posts -----------------------------------------


def hashtag_count(posts: DataFrame, window: str | None = None, more_than: int = 1) -> DataFrame:
    """Tag uses per topic; a tag repeated within a post counts each time."""
    tags = posts.select(*_times(posts), "topic", F.explode(_seen(posts, F.col("hashtags"))).alias("_tag"))
    tags = tags.select(*_times(posts), "topic", hashtag(F.col("_tag")).alias("hashtag"))
    return count_by(tags, window, ["hashtag", "topic"]).filter(F.col("cnt") > more_than)


def word_count(
    posts: DataFrame,
    window: str | None = None,
    more_than: int | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """Word uses per topic. Rare words are left out: above 10 uses over a whole
    input, above 1 per window, unless another threshold is given. A stream
    holds the texts of its open windows and counts their words at the close.
    ``among`` lists (word, topic): only their uses are counted."""
    if more_than is None:
        more_than = 10 if window is None else 1
    if posts.isStreaming and window is not None:
        counts = closed_word_count(posts, window, _times(posts)[-1], among)
        return counts.filter(F.col("cnt") > more_than)
    words = posts.select(*_times(posts), "topic", F.explode(tokens(F.col("text"))).alias("word"))
    words = words.filter(is_counted_word(F.col("word")))
    if among is not None:
        words = listed(words, among)
    return count_by(words, window, ["word", "topic"]).filter(F.col("cnt") > more_than)


def source_count(posts: DataFrame, window: str | None = None, more_than: int | None = None) -> DataFrame:
    """Client-app uses per topic: above 2 over a whole input, all per window."""
    if more_than is None:
        more_than = 2 if window is None else 0
    apps = posts.select(*_times(posts), "topic", F.explode(_seen(posts, source_apps(F.col("source")))).alias("source"))
    return count_by(apps, window, ["source", "topic"]).filter(F.col("cnt") > more_than)


def sentiment_count(
    posts: DataFrame, lexicon: dict[str, int] | DataFrame, window: str | None = None
) -> DataFrame:
    """Sentiment labels per topic over non-empty original posts. A lexicon is
    inlined when given as a dict of no more than ``MAX_INLINE_WORDS``, and
    joined when given as a table or larger; the labels are the same."""
    times = _times(posts)
    wanted = (F.col("text") != "") & (F.col("tweet_type") == ORIGINAL)
    rows = _only(posts, wanted, F.col(times[-1]) > F.lit(LONG_AGO).cast("timestamp"))
    if isinstance(lexicon, dict) and len(lexicon) > MAX_INLINE_WORDS:
        lexicon = posts.sparkSession.createDataFrame(list(lexicon.items()), "word STRING, weight INT")
    if isinstance(lexicon, DataFrame) and posts.isStreaming:
        labelled = stream_sentiment_by_join(rows, lexicon, window)
        keys = [F.window("_clock", window).alias("_window"), "sentiment", "topic"]
        counted = labelled.groupBy(*keys).agg(F.min("first").alias("_first"), F.sum("posts").alias("cnt"))
        return counted.select(
            F.col("_window.start").alias("window_start"), millis(F.col("_first")).alias("timestamp"),
            "sentiment", "topic", "cnt",
        )
    if isinstance(lexicon, DataFrame):
        labelled = sentiment_by_join(rows, lexicon)
    else:
        labelled = with_sentiment(rows, lexicon).select(*times, "topic", "sentiment")
    return count_by(labelled, window, ["sentiment", "topic"])


# --- users -------------------------------------------------------------------


def _users(posts: DataFrame) -> DataFrame:
    """The author of each post, or of the re-shared one."""

    def choose(shared: str, own: str) -> Column:
        return F.when(F.col("retweet"), F.col(shared)).otherwise(F.col(own)).alias(own)

    return posts.select(
        *_times(posts),
        "id",
        choose("retweet_account_name", "account_name"),
        choose("retweet_screen_name", "screen_name"),
        choose("retweet_followers", "followers"),
        choose("retweet_img_url", "img_url"),
    )


def _user_columns() -> Column:
    return F.struct(
        millis(F.col("ts")).alias("timestamp"),
        "account_name",
        "screen_name",
        "followers",
        "img_url",
    )


def distinct_users(posts: DataFrame) -> DataFrame:
    """One row per handle, as first seen."""
    first = F.min_by(_user_columns(), F.struct("ts", "id"))
    return _users(posts).groupBy("screen_name").agg(first.alias("_user")).select("_user.*")


def popular_user(posts: DataFrame, window: str = WINDOW, by: str = "first") -> DataFrame:
    """One user per window over all topics.

    ``by="first"`` keeps the first seen one, ``by="followers"`` the one with
    the most followers (ties: the smaller handle, then the earlier post).
    """
    order = {
        "first": F.struct("ts", "id"),
        "followers": F.struct((-F.col("followers")).alias("_rank"), "screen_name", "ts", "id"),
    }[by]
    chosen = _aggregate(
        _users(posts), window, [], F.min_by(_user_columns(), order).alias("_user")
    )
    return chosen.select("window_start", "_user.*")


USER_COLUMNS = ("timestamp", "account_name", "screen_name", "followers", "img_url")


def user_records(posts: DataFrame) -> DataFrame:
    """(ts, id, user): each post with its user's record as the post has it."""
    return _users(posts).select(*_times(posts), "id", _user_columns().alias("user"))


def first_of_windows(records: DataFrame, window: str = WINDOW) -> DataFrame:
    """Of (ts, id, user) the user of each window's first post."""
    chosen = _aggregate(records, window, [], F.min_by("user", F.struct("ts", "id")).alias("_user"))
    return chosen.select("window_start", "_user.*")


def popular_user_running(posts: DataFrame, window: str = WINDOW) -> DataFrame:
    """The user of each window's first post, with the record that user's handle
    had when it was first seen in the whole input, of whatever window. (On a
    stream: ``stream_popular_user``, which keeps these records as state.)

    Both sides are small before they meet: a row per window, a row per handle."""
    records = user_records(posts)
    firsts = records.groupBy(F.col("user.screen_name").alias("_handle")).agg(
        F.min_by("user", F.struct("ts", "id")).alias("_user")
    )
    chosen = first_of_windows(records, window).select("window_start", F.col("screen_name").alias("_chosen"))
    met = chosen.join(firsts, F.col("_chosen").eqNullSafe(F.col("_handle")))
    return met.select("window_start", "_user.*")
