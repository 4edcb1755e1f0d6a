"""Post rows derived from general event and document tables.

Four mappings: ``posts`` (one post per event), ``document_posts`` (one post
per document, with its whole text), ``turn_posts`` (one post per conversation
turn) and ``raw_lines`` (document posts and limit notices in the collector's
line format, mixed with junk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.topics import TopicRules, route_topics
from ..session import stage

# Needles that occur in the table texts.
TABLE_TOPICS = TopicRules(
    needles=(("sch", "alpha"), ("que", "beta"), ("ment", "gamma"), ("tion", "delta")),
    default="other",
)

SCHEMAS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
        "value DOUBLE, props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "benchmark": "item_id BIGINT, text STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, stored as one file or as a folder of files. (The
    last letter is a glob: only that lets a stream read a single file.)"""
    table(spark, sf_dir, name)  # fails where there is none; a stream would wait for it
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parque[t]")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document reduced to its topic, language and source.

    Partitioned by document, which the join with events needs at scale anyway:
    without that exchange Spark would put the topic rules off into the join and
    apply them again for every event of a document. No document can be hot
    there, as ``event_posts`` deals the events out evenly.
    """
    return (
        route_topics(table(spark, sf_dir, "documents"), TABLE_TOPICS, F.col("text"))
        .select("doc_id", "topic", "lang", F.col("source").alias("doc_source"))
        .repartition("doc_id")
    )


def event_posts(event_rows: DataFrame, topics: DataFrame, n_documents: Column) -> DataFrame:
    """Post rows without texts: event ``i`` is about document ``i`` modulo
    their number. Only the documents' topics travel through the join."""
    joined = (
        event_rows.withColumn("_n", n_documents)
        .selectExpr(
            "*",
            "event_id % _n AS doc_id",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
            """CASE WHEN event_type IN ('view', 'click') THEN 'Retweet'
                    WHEN event_type = 'error' THEN 'Reply' ELSE 'Original Tweet' END
               AS tweet_type""",
            "CONCAT('u', CAST(user_id * 7 % 150 AS STRING)) AS author",
        )
        .join(topics, "doc_id")
    )
    return joined.selectExpr(
        "event_id AS id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "topic",
        "tweet_type",
        "tweet_type = 'Retweet' AS retweet",
        "lang",
        """CASE WHEN k % 10 = 0 THEN '' WHEN k % 10 = 1 THEN 'web'
                ELSE CONCAT('<a href="https://x.example/', doc_source, '" rel="nofollow">',
                            doc_source, '</a>') END AS source""",
        "CONCAT('User ', CAST(user_id AS STRING)) AS account_name",
        "CONCAT('u', CAST(user_id AS STRING)) AS screen_name",
        "user_id",
        "user_id * 10 + k AS followers",
        "CONCAT('https://x.example/img/', CAST(user_id AS STRING)) AS img_url",
        """CASE WHEN k % 3 = 1 THEN array(upper(lang))
                WHEN k % 3 = 2 THEN array(upper(lang), doc_source)
                ELSE CAST(array() AS ARRAY<STRING>) END AS hashtags""",
        "IF(tweet_type = 'Retweet', CONCAT('Author ', author), '') AS retweet_account_name",
        "IF(tweet_type = 'Retweet', author, '') AS retweet_screen_name",
        "IF(tweet_type = 'Retweet', FLOOR(value * 10), 0L) AS retweet_num_retweets",
        "IF(tweet_type = 'Retweet', k * 100 + user_id, 0L) AS retweet_followers",
        """IF(tweet_type = 'Retweet', CONCAT('https://x.example/img/', author), '')
           AS retweet_img_url""",
    )


def posts(spark: SparkSession, sf_dir: str, event_rows: DataFrame | None = None) -> DataFrame:
    """One post per event; ``event_rows`` narrows or streams the events."""
    rows = events(spark, sf_dir) if event_rows is None else event_rows
    topics = document_topics(spark, sf_dir)
    # Answered from the file footers.
    counted = table(spark, sf_dir, "documents").select(F.count(F.lit(1)))
    if rows.isStreaming:
        # Micro-batches read small stored results instead of all texts again.
        return event_posts(rows, stage(topics, "topics"), F.lit(counted.first()[0]))
    return event_posts(rows, topics, counted.scalar())


def document_posts(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """One post per document, a minute apart, with the whole text."""
    rows = documents(spark, sf_dir) if rows is None else rows
    routed = route_topics(rows, TABLE_TOPICS, F.col("text"))
    return routed.selectExpr(
        "doc_id AS id",
        "timestamp_seconds(1704067200 + doc_id * 60) AS ts",
        "topic",
        """CASE doc_id % 3 WHEN 0 THEN 'Retweet' WHEN 1 THEN 'Reply'
                ELSE 'Original Tweet' END AS tweet_type""",
        "doc_id % 3 = 0 AS retweet",
        "text",
        "lang",
        "source",
        "n_chars",
    )


def turn_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per conversation turn: openings are originals, the rest replies.
    Conversations start an hour apart, turns follow by the second."""
    turns = table(spark, sf_dir, "conversations")
    return route_topics(turns, TABLE_TOPICS, F.col("text")).selectExpr(
        "conv_id",
        "turn",
        "timestamp_seconds(1704067200 + conv_id * 3600 + turn) AS ts",
        "topic",
        "IF(turn = 0, 'Original Tweet', 'Reply') AS tweet_type",
        "CAST(coalesce(text, '') AS STRING) AS text",
        """CONCAT('<a href="https://x.example/', role, '">', role, '</a>') AS source""",
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a raw post line, every event as a limit notice or junk."""
    return document_lines(documents(spark, sf_dir)).unionByName(event_lines(events(spark, sf_dir)))


def document_lines(document_rows: DataFrame) -> DataFrame:
    """Documents as raw post lines."""
    return document_rows.selectExpr(
        # explode() keeps tests of the line from repeating the encoder.
        """explode(array(to_json(named_struct(
             'created_at', date_format(timestamp_seconds(1704067200 + doc_id * 60),
                                       'EEE MMM dd HH:mm:ss Z yyyy'),
             'id', doc_id,
             'text', IF(doc_id % 3 = 0, CONCAT('RT ', substring(text, 1, 5)), text),
             'source', CONCAT('<a href="https://x.example/', source, '">', source, '</a>'),
             'lang', lang,
             'in_reply_to_status_id', IF(doc_id % 3 = 1, doc_id + 1, NULL),
             'user', named_struct(
               'id', doc_id,
               'name', CONCAT('User ', CAST(doc_id AS STRING)),
               'screen_name', CONCAT('u', CAST(doc_id % 150 AS STRING)),
               'followers_count', n_chars,
               'verified', doc_id % 2 = 0),
             'entities', named_struct(
               'urls', array(named_struct('expanded_url', CONCAT('https://x.example/', source))),
               'hashtags', array(named_struct('text', upper(lang)), named_struct('text', source))),
             'retweeted_status', IF(doc_id % 3 = 0, named_struct(
               'id', doc_id + 1000000,
               'text', text,
               'retweet_count', n_chars % 97,
               'user', named_struct('name', 'Author', 'screen_name', source,
                                    'followers_count', n_chars * 3)), NULL)
           )))) AS value"""
    )


def event_lines(event_rows: DataFrame) -> DataFrame:
    """Errors as limit notices, all other events as lines that are no posts."""
    return event_rows.selectExpr(
        """CASE event_type
             WHEN 'error' THEN CONCAT('{"limit":{"track":', CAST(user_id AS STRING),
               ',"timestamp_ms":"', CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS STRING), '"}}')
             WHEN 'view' THEN '{"created_at":"not a date","user":{"id":1}}'
             WHEN 'click' THEN '{"created_at":"Sun Oct 27 19:09'
             WHEN 'signup' THEN ''
             ELSE CONCAT('{"id":', CAST(event_id AS STRING), '}') END AS value"""
    )
