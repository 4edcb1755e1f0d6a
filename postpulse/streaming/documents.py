"""Metric rows as the JSON documents a search index or dashboard reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ascii_only

# Document fields in order, each with the column it is read from.
FIELDS: dict[str, tuple[tuple[str, str], ...]] = {
    "total_count": (
        ("cnt", "cnt"), ("tweetType", "tweet_type"), ("timestamp", "timestamp"),
        ("trackterm", "topic"),
    ),
    "topic_count": (("cnt", "cnt"), ("trackterm", "topic"), ("timestamp", "timestamp")),
    "avg_retweets": (
        ("cnt", "cnt"), ("RetweetTweetType", "tweet_type"), ("timestamp", "timestamp"),
        ("retweets", "retweets"), ("trackterm", "topic"),
    ),
    "avg_length": (
        ("cnt", "cnt"), ("timestamp", "timestamp"), ("length", "length"), ("trackterm", "topic"),
    ),
    "hashtag": (
        ("cnt", "cnt"), ("hashtag", "hashtag"), ("timestamp", "timestamp"), ("trackterm", "topic"),
    ),
    "word": (
        ("cnt", "cnt"), ("timestamp", "timestamp"), ("word", "word"), ("trackterm", "topic"),
    ),
    "source": (
        ("cnt", "cnt"), ("source", "source"), ("timestamp", "timestamp"), ("searchTerm", "topic"),
    ),
    "sentiment": (
        ("cnt", "cnt"), ("tweetType", "tweet_type"), ("timestamp", "timestamp"),
        ("sentiment", "sentiment"), ("trackterm", "topic"),
    ),
    "retweets_followers": (
        ("cnt", "cnt"), ("followers", "followers"), ("timestamp", "timestamp"),
        ("retweets", "retweets"), ("trackterm", "topic"),
    ),
    "popular_user": (
        ("follower_count", "followers"), ("username", "screen_name"),
        ("accountname", "account_name"), ("img", "img_url"), ("timestamp", "timestamp"),
    ),
}

# The type field of metrics that look at one post type only.
IMPLIED_TYPE = {"avg_retweets": "Retweet", "sentiment": "Original Tweet"}

# Index that receives each metric, per job.
LIVE_INDEX = {
    "total_count": "tweetcount-idx",
    "avg_retweets": "avgretweetscount-idx",
    "hashtag": "hashtagcount-idx",
    "popular_user": "popularuser-idx",
    "topic_count": "counttrackterms-idx",
    "source": "sourcecount-idx",
    "word": "wordcount-idx",
    "avg_length": "tweetlength-idx",
    "retweets_followers": "retweetsfollowers-idx",
    "sentiment": "sentiment-idx",
}
COMPARE_INDEX = {
    "hashtag": "comphashtagcount-idx",
    "word": "compwordcount-idx",
    "source": "compsourcecount-idx",
    "total_count": "comptweetcount-idx",
    "avg_length": "comptweetlength-idx",
    "avg_retweets": "compavgretweetscount-idx",
}
PREDICT_INDEX = {
    "avg_length": "predtweetlength-idx",
    "avg_retweets": "predavgretweetscount-idx",
    "retweets_followers": "predretweetsfollowers-idx",
}


def documents(rows: DataFrame, metric: str, *beside: Column) -> DataFrame:
    """One JSON document per row, in a ``value`` column, with other columns
    beside it. Texts lose their non-ASCII characters, except in user documents."""
    types = dict(rows.dtypes)

    def field(name: str, column: str) -> Column:
        if column == "tweet_type" and column not in types:
            return F.lit(IMPLIED_TYPE[metric]).alias(name)
        value = F.col(column)
        if types[column] == "string" and metric != "popular_user":
            value = ascii_only(value)
        return value.alias(name)

    return rows.select(*beside, F.to_json(F.struct(*[field(*pair) for pair in FIELDS[metric]])).alias("value"))
