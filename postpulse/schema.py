"""Declared schemas: raw JSON lines, post rows and stored baselines."""

from __future__ import annotations

_USER = """STRUCT<
    id: BIGINT, name: STRING, screen_name: STRING, profile_image_url: STRING,
    description: STRING, location: STRING, followers_count: BIGINT,
    verified: BOOLEAN>"""

# One raw line as the collector stores it.
RAW_POST = f"""
    created_at STRING,
    id BIGINT,
    text STRING,
    source STRING,
    lang STRING,
    in_reply_to_status_id BIGINT,
    favorite_count INT,
    retweet_count INT,
    user {_USER},
    entities STRUCT<
        urls: ARRAY<STRUCT<expanded_url: STRING>>,
        hashtags: ARRAY<STRUCT<text: STRING>>>,
    retweeted_status STRUCT<
        id: BIGINT, text: STRING, retweet_count: BIGINT, user: {_USER}>,
    quoted_status STRUCT<text: STRING>
"""

# One typed post, as every operator reads it.
POST = """
    id BIGINT,
    ts TIMESTAMP,
    topic STRING,
    tweet_type STRING,
    retweet BOOLEAN,
    text STRING,
    lang STRING,
    source STRING,
    account_name STRING,
    screen_name STRING,
    user_id BIGINT,
    followers BIGINT,
    verified BOOLEAN,
    img_url STRING,
    profile_text STRING,
    profile_location STRING,
    in_reply_to BIGINT,
    has_links BOOLEAN,
    links STRING,
    has_hashtags BOOLEAN,
    hashtags ARRAY<STRING>,
    favorite_count INT,
    retweet_count INT,
    retweet_id BIGINT,
    retweet_account_name STRING,
    retweet_screen_name STRING,
    retweet_num_retweets BIGINT,
    retweet_followers BIGINT,
    retweet_img_url STRING
"""

# The column of a post's arrival, where windows go by that.
ARRIVAL = "_arrival"

# The three post types.
RETWEET = "Retweet"
REPLY = "Reply"
ORIGINAL = "Original Tweet"

# Stored results in file column order; they double as compare/predict baselines.
STORED = {
    "total_count": "timestamp BIGINT, topic STRING, tweet_type STRING, cnt BIGINT",
    "avg_retweets": "timestamp BIGINT, retweets INT, topic STRING, cnt INT",
    "avg_length": "timestamp BIGINT, length INT, topic STRING, cnt INT",
    "sentiment": "timestamp BIGINT, sentiment STRING, topic STRING, cnt BIGINT",
    "hashtag": "timestamp BIGINT, hashtag STRING, topic STRING, cnt BIGINT",
    "word": "timestamp BIGINT, word STRING, topic STRING, cnt BIGINT",
    "topic_count": "timestamp BIGINT, topic STRING, cnt BIGINT",
    "source": "timestamp BIGINT, topic STRING, source STRING, cnt BIGINT",
    "popular_user": (
        "timestamp BIGINT, account_name STRING, screen_name STRING, "
        "followers BIGINT, img_url STRING"
    ),
    "word_topn": "word STRING, topic STRING",
    "hashtag_topn": "hashtag STRING, topic STRING",
    "source_topn": "timestamp BIGINT, source STRING, topic STRING, cnt BIGINT",
    "type_rollup": "name_id STRING, timestamp BIGINT, tweet_type STRING, cnt BIGINT",
}
