"""Every operator as a query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.functions import text as tx
from postpulse.functions.numeric import millis
from postpulse.functions.topics import TopicRules, route_topics
from postpulse.operators import compare, metrics, predict, topn
from postpulse.session import scratch_path, stage
from postpulse.sources import baselines, raw, tables
from postpulse.sources.lines import stream_folder
from postpulse.sources.posts import store_posts
from postpulse.streaming.documents import documents
from postpulse.streaming.index import index_rows, read_index, start_index
from postpulse.streaming.losses import as_rows, watching
from postpulse.streaming.sinks import save_lines, start_documents, write_csv
from postpulse.streaming.stateful import (
    of_width,
    stream_difference,
    stream_line,
    stream_popular_user,
    stream_smoothed,
    stream_summaries,
    stream_top_of_windows,
)
from postpulse.streaming.windows import (
    complete,
    end,
    event_time,
    open_ending,
    run_to_table,
)

from .oracle import LEXICON, SPLIT

DAY, HOUR = "1 day", "1 hour"
# Baseline period of the event posts: 1 to 16 January 2024, in day windows.
BASELINE_WINDOWS = baselines.windows_between(1704067200000, 1705363200000, 86_400_000)

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame) -> DataFrame:
    """Window starts as epoch milliseconds, like every other time here."""
    if "window_start" in df.columns:
        return df.withColumn("window_start", millis(F.col("window_start")))
    return df


def _posts(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: _plain(operator(tables.posts(spark, sf), *args, **kwargs))


def _texts(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: _plain(operator(tables.document_posts(spark, sf), *args, **kwargs))


def _turns(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf: _plain(operator(tables.turn_posts(spark, sf), *args, **kwargs))


def _event_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Baseline and live posts. The split is on the stored column, so each
    side's scan skips the other's row groups."""
    events = tables.events(spark, sf)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    return (
        tables.posts(spark, sf, events.filter(F.col("ts") < split)),
        tables.posts(spark, sf, events.filter(F.col("ts") >= split)),
    )


def _half_documents(spark: SparkSession, sf: str, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of the lower and upper half of the id range. The split is on
    the stored column, so each side's scan skips the other's row groups."""
    ids = tables.table(spark, sf, "documents").agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((ids[0] or 0) + (ids[1] or 0)) // 2
    return rows.filter(F.col("doc_id") < middle), rows.filter(F.col("doc_id") >= middle)


def _text_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    halves = _half_documents(spark, sf, tables.documents(spark, sf))
    return tuple(tables.document_posts(spark, sf, half) for half in halves)


def cmp_avg_retweets(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _event_halves(spark, sf)
    return _plain(
        compare.compare_avg_retweets(metrics.avg_retweets(live, DAY), metrics.avg_retweets(stored))
    )


def cmp_avg_length(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _text_halves(spark, sf)
    return _plain(compare.compare_avg_length(metrics.avg_length(live, HOUR), metrics.avg_length(stored)))


def cmp_total_count(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _event_halves(spark, sf)
    per_window = baselines.per_window(metrics.total_count(stored), BASELINE_WINDOWS)
    return _plain(compare.compare_total_count(metrics.total_count(live, DAY), per_window))


def cmp_source(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _event_halves(spark, sf)
    per_window = baselines.per_window(topn.top_sources(stored), BASELINE_WINDOWS)
    return _plain(compare.compare_source(metrics.source_count(live, DAY), per_window))


def cmp_hashtag(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _event_halves(spark, sf)
    tags = metrics.hashtag_count(live, DAY, more_than=0)
    return _plain(compare.compare_hashtag(tags, topn.top_hashtags(stored)))


def cmp_word(spark: SparkSession, sf: str) -> DataFrame:
    stored, live = _text_halves(spark, sf)
    words = metrics.word_count(live, HOUR, more_than=0)
    return _plain(compare.compare_word(words, topn.top_words(stored)))


def pred_avg_retweets(spark: SparkSession, sf: str) -> DataFrame:
    # One pass over the posts: the seeds follow from the windows.
    summary = stage(metrics.topic_summary(tables.posts(spark, sf), HOUR), "summary")
    seeds = metrics.avg_retweets_of(metrics.whole_of(summary))
    return _plain(predict.predict_avg_retweets(metrics.avg_retweets_of(summary), seeds))


def pred_avg_length(spark: SparkSession, sf: str) -> DataFrame:
    summary = stage(metrics.topic_summary(tables.document_posts(spark, sf), HOUR), "summary")
    seeds = metrics.avg_length_of(metrics.whole_of(summary))
    return _plain(predict.predict_avg_length(metrics.avg_length_of(summary), seeds))


def pred_retweets_followers(spark: SparkSession, sf: str) -> DataFrame:
    posts = tables.posts(spark, sf)
    return _plain(predict.predict_retweets_followers(metrics.retweets_followers(posts, HOUR)))


def sentiment_lexicon_table(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [F.lit(item) for pair in LEXICON.items() for item in pair]
    lexicon = spark.range(1).select(F.explode(F.create_map(*pairs)).alias("word", "weight"))
    return metrics.sentiment_count(tables.document_posts(spark, sf), lexicon)


def stream_sentiment_lexicon_table(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [F.lit(item) for pair in LEXICON.items() for item in pair]
    lexicon = spark.range(1).select(F.explode(F.create_map(*pairs)).alias("word", "weight"))
    rows = metrics.sentiment_count(_streamed_texts(spark, sf), lexicon, HOUR)
    return _plain(run_to_table(rows, "stream_sentiment_lexicon_table"))


def topic_route(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.table(spark, sf, "documents")
    return route_topics(rows, tables.TABLE_TOPICS, F.col("text")).select("doc_id", "topic")


def _needles(spark: SparkSession, sf: str, pattern: str) -> list[str]:
    """Matches of a pattern in the benchmark's texts, each once, in order: as
    many needles as a setting may have."""
    text = F.lower(F.col("text"))
    found = F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("needle")
    rows = tables.table(spark, sf, "benchmark").select(found).distinct().orderBy("needle")
    return [row.needle for row in rows.collect()]


def topic_route_many(spark: SparkSession, sf: str) -> DataFrame:
    """Topics by a rule for each longer word of the benchmark."""
    rules = TopicRules(tuple((word, word) for word in _needles(spark, sf, "[a-z]{6,}")), "none")
    rows = tables.table(spark, sf, "documents")
    return route_topics(rows, rules, F.col("text")).select("doc_id", "topic")


def source_filter_many(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with both words of any pair of neighbours in the benchmark."""
    pairs = _needles(spark, sf, "[a-z]{4,} [a-z]{4,}")
    rows = tables.table(spark, sf, "documents").select(
        "doc_id", "text", F.lit("").alias("links"), F.array().cast("array<string>").alias("hashtags")
    )
    return raw.select_posts(rows, terms=",".join(pairs)).select("doc_id")


def source_anchor(spark: SparkSession, sf: str) -> DataFrame:
    source = F.col("source")
    found = F.arrays_zip(tx.source_apps(source).alias("app"), tx.source_links(source).alias("link"))
    return tables.posts(spark, sf).select("id", F.inline(found).alias("app", "link"))


def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return tables.documents(spark, sf).select(
        "doc_id",
        tx.clean_text(text).alias("cleaned"),
        tx.ascii_only(text).alias("ascii"),
        tx.utf16_length(text).alias("units"),
    )


def limit_notices(spark: SparkSession, sf: str) -> DataFrame:
    return raw.parse_limits(tables.raw_lines(spark, sf))


def loss_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of the raw lines, counted by the pass that parses them."""
    counts = raw.LineCounts()
    posts = raw.parse_posts(tables.raw_lines(spark, sf), tables.TABLE_TOPICS, counts=counts)
    posts.write.format("noop").mode("overwrite").save()
    return as_rows(spark, counts.get())


def stream_loss_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The same of a stream, summed over its micro-batches."""
    lines = tables.document_lines(tables.stream_table(spark, sf, "documents")).unionByName(
        tables.event_lines(tables.stream_table(spark, sf, "events"))
    )
    path = scratch_path(spark, "counted")
    with watching(spark, raw.LineCounts("counted")) as log:
        posts = raw.parse_posts(lines, tables.TABLE_TOPICS, counts=log.counts)
        query = store_posts(posts, path, f"{path}-checkpoint")
        query.awaitTermination()
        return as_rows(spark, log.after(query))


def parse_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(raw.parse_posts(tables.raw_lines(spark, sf), tables.TABLE_TOPICS))


def _parsed(posts: DataFrame) -> DataFrame:
    return posts.select(
        "id", millis(F.col("ts")).alias("timestamp"), "topic", "tweet_type", "text", "lang",
        "source", "account_name", "screen_name", "followers", "verified", "in_reply_to", "links",
        F.array_join("hashtags", " ").alias("hashtags"), "retweet_id", "retweet_screen_name",
        "retweet_num_retweets", "retweet_followers",
    )


def source_filter(spark: SparkSession, sf: str) -> DataFrame:
    posts = raw.parse_posts(tables.raw_lines(spark, sf), tables.TABLE_TOPICS)
    kept = raw.select_posts(posts, langs="en,de,fr", terms="der die,the src7", users="1,4,7")
    return kept.select("id", "lang", "topic")


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(metrics.hashtag_count(tables.posts(spark, sf), DAY), "hashtag")


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    return complete(tables.posts(spark, sf, tables.stream_table(spark, sf, "events")))


def _streamed_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.stream_table(spark, sf, "documents")
    return complete(tables.document_posts(spark, sf, rows))


def _stream(label: str, source: Query, operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    """A windowed metric of a stream that ends with what the table holds."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _plain(run_to_table(operator(source(spark, sf), *args, **kwargs), label))

    return run


def stream_arrival_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Counts in windows of arrival, summed up: the batch totals, each with the
    time of its first post."""
    posts = tables.posts(spark, sf, tables.stream_table(spark, sf, "events"))
    closing = open_ending(posts, scratch_path(spark, "closing"))
    end(spark, closing, posts.schema)
    timed = event_time(posts, time_domain="processing", closing=closing)
    rows = run_to_table(metrics.total_count(timed, HOUR), "stream_arrival_totals")
    return rows.groupBy("topic", "tweet_type").agg(
        F.min("timestamp").alias("timestamp"), F.sum("cnt").alias("cnt")
    )


def stream_pred_avg_length(spark: SparkSession, sf: str) -> DataFrame:
    seeds = stage(metrics.avg_length(tables.document_posts(spark, sf)), "seeds")
    series = metrics.avg_length(_streamed_texts(spark, sf), HOUR)
    return _plain(run_to_table(stream_smoothed(series, seeds, "length"), "stream_pred_avg_length"))


def stream_parse_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines collected from one stream and parsed in another."""
    path = scratch_path(spark, "lines")
    lines = tables.document_lines(tables.stream_table(spark, sf, "documents")).unionByName(
        tables.event_lines(tables.stream_table(spark, sf, "events"))
    )
    save_lines(lines, path, f"{path}-checkpoint").awaitTermination()
    posts = raw.parse_posts(raw.stream_lines(spark, path), tables.TABLE_TOPICS)
    return _parsed(run_to_table(posts, "stream_parse_roundtrip"))


def stream_source_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines of a folder, read in steps by a query that ends and starts
    again after each of them."""
    path = scratch_path(spark, "folder")
    tables.raw_lines(spark, sf).repartition(6).write.text(path)
    lines = stream_folder(spark, path, f"{path}-order", batchFiles=2, splitBytes=1 << 20)
    posts = _parsed(raw.parse_posts(lines, tables.TABLE_TOPICS))
    label = "stream_source_lines"
    held = -1
    while held != (found := run_to_table(posts, label, f"{path}-posts")).count():
        held = found.count()
    return found


def stream_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of two indexes that one windowed summary fills."""
    path = scratch_path(spark, "documents")
    outputs = [
        ("total_count", "tweetcount-idx", metrics.total_count_of),
        ("topic_count", "counttrackterms-idx", metrics.topic_count_of),
    ]
    start_documents(
        metrics.topic_summary(_streamed(spark, sf), DAY), "stream_documents", path,
        f"{path}-checkpoint", outputs,
    ).awaitTermination()
    both = [spark.read.text(f"{path}/{index}").select("value") for _, index, _ in outputs]
    return both[0].unionAll(both[1])


def stream_index(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of two streams in one index store, each id once."""
    path = scratch_path(spark, "index")
    streams = [
        ("total_count", "tweetcount-idx", metrics.total_count),
        ("hashtag", "hashtagcount-idx", metrics.hashtag_count),
    ]
    for metric, index, operator in streams:
        rows = index_rows(operator(_streamed(spark, sf), DAY), metric, index)
        start_index(rows, f"index_{metric}", path, f"{path}-checkpoint").awaitTermination()
    found = read_index(spark, path)
    ids = F.count_distinct("id").alias("ids")
    return found.select("index", "value").unionAll(found.groupBy("index").agg(ids.cast("string").alias("value")))


def stream_limit_notices(spark: SparkSession, sf: str) -> DataFrame:
    """Lines collected from a stream, then read back and parsed."""
    path = scratch_path(spark, "lines")
    lines = tables.event_lines(tables.stream_table(spark, sf, "events"))
    save_lines(lines, path, f"{path}-checkpoint").awaitTermination()
    return raw.parse_limits(raw.read_lines(spark, path))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A stored result, read back as a baseline."""
    path = scratch_path(spark, "totalcount.csv")
    write_csv(metrics.total_count(tables.posts(spark, sf)), path, one_file=True)
    return baselines.read_stored(spark, path, "total_count")


def _stream_cmp(
    metric: str,
    stored_of: Callable[..., DataFrame],
    live_of: Callable[..., DataFrame],
    texts: bool = False,
    loaded: tuple[list[str], str] | None = None,
    among: bool = False,
) -> Query:
    """A stream's windows against a stored result: stream-static or, given the
    keys and the value, with the stored result loaded into state. With ``among``
    the live metric takes the stored result, too: only its keys are compared."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        if texts:
            stored, _ = _text_halves(spark, sf)
            _, rows = _half_documents(spark, sf, tables.stream_table(spark, sf, "documents"))
            live = tables.document_posts(spark, sf, rows)
        else:
            stored, _ = _event_halves(spark, sf)
            rows = tables.stream_table(spark, sf, "events").filter(
                F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")
            )
            live = tables.posts(spark, sf, rows)
        baseline = stage(stored_of(stored), f"baseline_{metric}")
        windows = live_of(complete(live), baseline) if among else live_of(complete(live))
        if loaded:
            compared = stream_difference(windows, baseline, *loaded)
        else:
            compared = getattr(compare, f"compare_{metric}")(windows, baseline)
        return _plain(run_to_table(compared, f"stream_cmp_{metric}"))

    return run


def stream_pred_avg_retweets(spark: SparkSession, sf: str) -> DataFrame:
    seeds = stage(metrics.avg_retweets(tables.posts(spark, sf)), "seeds")
    series = metrics.avg_retweets(_streamed(spark, sf), HOUR)
    return _plain(run_to_table(stream_smoothed(series, seeds, "retweets"), "stream_pred_avg_retweets"))


def stream_pred_retweets_followers(spark: SparkSession, sf: str) -> DataFrame:
    rows = stream_line(metrics.retweets_followers(_streamed(spark, sf), HOUR))
    return _plain(run_to_table(rows, "stream_pred_retweets_followers"))


def stream_widths(spark: SparkSession, sf: str) -> DataFrame:
    """Counts in windows of three widths, from one pass and one state."""
    widths = [metrics.WINDOW, HOUR, DAY]
    found = run_to_table(stream_summaries(_streamed(spark, sf), widths), "stream_widths")
    counts = [metrics.total_count_of(of_width(found, w)).withColumn("width", F.lit(w)) for w in widths]
    return _plain(counts[0].unionAll(counts[1]).unionAll(counts[2]))


def _json(metric: str, source: Query, operator: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: documents(operator(source(spark, sf), *args), metric)


QUERIES: dict[str, Query] = {
    "total_count": _posts(metrics.total_count),
    "topic_count": _posts(metrics.topic_count),
    "type_rollup": _posts(metrics.type_rollup),
    "avg_retweets": _posts(metrics.avg_retweets),
    "avg_length": _texts(metrics.avg_length),
    "retweets_followers": _posts(metrics.retweets_followers),
    "hashtag_count": _posts(metrics.hashtag_count),
    "word_count": _texts(metrics.word_count),
    "source_count": _posts(metrics.source_count),
    "sentiment_count": _texts(metrics.sentiment_count, LEXICON),
    "sentiment_lexicon_table": sentiment_lexicon_table,
    "distinct_users": _posts(metrics.distinct_users),
    "win_total_count": _posts(metrics.total_count, DAY),
    "win_topic_count": _posts(metrics.topic_count, DAY),
    "win_topic_count_60s": _posts(metrics.topic_count, metrics.WINDOW),
    "win_avg_retweets": _posts(metrics.avg_retweets, DAY),
    "win_avg_length": _texts(metrics.avg_length, HOUR),
    "win_retweets_followers": _posts(metrics.retweets_followers, DAY),
    "win_hashtag_count": _posts(metrics.hashtag_count, DAY),
    "win_word_count": _texts(metrics.word_count, HOUR),
    "win_source_count": _posts(metrics.source_count, DAY),
    "win_sentiment_count": _texts(metrics.sentiment_count, LEXICON, HOUR),
    "win_popular_first": _posts(metrics.popular_user, DAY, "first"),
    "win_popular_top": _posts(metrics.popular_user, DAY, "followers"),
    "win_popular_running": _posts(metrics.popular_user_running, DAY),
    "word_topn": _texts(topn.top_words),
    "hashtag_topn": _posts(topn.top_hashtags),
    "source_topn": _posts(topn.top_sources),
    "win_word_topn": _texts(topn.top_of_windows, "word", DAY),
    "win_hashtag_topn": _posts(topn.top_of_windows, "hashtag", DAY, 3),
    "win_source_topn": _posts(topn.top_of_windows, "source", DAY),
    "total_topn": _posts(lambda posts: topn.top_n(metrics.total_count(posts), "tweet_type", 2)),
    "turn_total_count": _turns(metrics.total_count),
    "turn_win_avg_length": _turns(metrics.avg_length, DAY),
    "turn_word_topn": _turns(topn.top_words),
    "turn_win_source_count": _turns(metrics.source_count, DAY),
    "turn_sentiment_count": _turns(metrics.sentiment_count, LEXICON),
    "cmp_avg_retweets": cmp_avg_retweets,
    "cmp_avg_length": cmp_avg_length,
    "cmp_total_count": cmp_total_count,
    "cmp_source": cmp_source,
    "cmp_hashtag": cmp_hashtag,
    "cmp_word": cmp_word,
    "pred_avg_retweets": pred_avg_retweets,
    "pred_avg_length": pred_avg_length,
    "pred_retweets_followers": pred_retweets_followers,
    "topic_route": topic_route,
    "topic_route_many": topic_route_many,
    "source_anchor": source_anchor,
    "text_clean": text_clean,
    "limit_notices": limit_notices,
    "loss_counts": loss_counts,
    "stream_loss_counts": stream_loss_counts,
    "parse_roundtrip": parse_roundtrip,
    "source_filter": source_filter,
    "source_filter_many": source_filter_many,
    "json_documents": json_documents,
    "csv_roundtrip": csv_roundtrip,
    "json_avg_retweets": _json("avg_retweets", tables.posts, metrics.avg_retweets),
    "json_avg_length": _json("avg_length", tables.document_posts, metrics.avg_length),
    "json_word": _json("word", tables.document_posts, metrics.word_count),
    "json_source": _json("source", tables.posts, metrics.source_count),
    "json_sentiment": _json("sentiment", tables.document_posts, metrics.sentiment_count, LEXICON),
    "json_retweets_followers": _json("retweets_followers", tables.posts, metrics.retweets_followers),
    "json_popular_user": _json("popular_user", tables.posts, metrics.popular_user, DAY),
    "stream_total_count": _stream("stream_total_count", _streamed, metrics.total_count, HOUR),
    "stream_topic_count": _stream("stream_topic_count", _streamed, metrics.topic_count, DAY),
    "stream_avg_retweets": _stream("stream_avg_retweets", _streamed, metrics.avg_retweets, HOUR),
    "stream_avg_length": _stream("stream_avg_length", _streamed_texts, metrics.avg_length, HOUR),
    "stream_retweets_followers": _stream(
        "stream_retweets_followers", _streamed, metrics.retweets_followers, DAY
    ),
    "stream_hashtag_count": _stream("stream_hashtag_count", _streamed, metrics.hashtag_count, DAY),
    "stream_word_count": _stream("stream_word_count", _streamed_texts, metrics.word_count, HOUR),
    "stream_source_count": _stream("stream_source_count", _streamed, metrics.source_count, DAY),
    "stream_sentiment_count": _stream(
        "stream_sentiment_count", _streamed_texts, metrics.sentiment_count, LEXICON, HOUR
    ),
    "stream_sentiment_lexicon_table": stream_sentiment_lexicon_table,
    "stream_popular_first": _stream("stream_popular_first", _streamed, metrics.popular_user, DAY),
    "stream_popular_top": _stream(
        "stream_popular_top", _streamed, metrics.popular_user, DAY, "followers"
    ),
    "stream_popular_running": _stream("stream_popular_running", _streamed, stream_popular_user, DAY),
    "stream_word_topn": _stream("stream_word_topn", _streamed_texts, stream_top_of_windows, "word", DAY),
    "stream_hashtag_topn": _stream("stream_hashtag_topn", _streamed, stream_top_of_windows, "hashtag", DAY, 3),
    "stream_source_topn": _stream("stream_source_topn", _streamed, stream_top_of_windows, "source", DAY),
    "stream_arrival_totals": stream_arrival_totals,
    "stream_parse_roundtrip": stream_parse_roundtrip,
    "stream_source_lines": stream_source_lines,
    "stream_documents": stream_documents,
    "stream_index": stream_index,
    "stream_limit_notices": stream_limit_notices,
    "stream_cmp_avg_retweets": _stream_cmp(
        "avg_retweets", metrics.avg_retweets, lambda live: metrics.avg_retweets(live, DAY)
    ),
    "stream_cmp_avg_length": _stream_cmp(
        "avg_length", metrics.avg_length, lambda live: metrics.avg_length(live, HOUR), texts=True
    ),
    "stream_cmp_total_count": _stream_cmp(
        "total_count",
        lambda stored: baselines.per_window(metrics.total_count(stored), BASELINE_WINDOWS),
        lambda live: metrics.total_count(live, DAY),
    ),
    "stream_cmp_source": _stream_cmp(
        "source",
        lambda stored: baselines.per_window(topn.top_sources(stored), BASELINE_WINDOWS),
        lambda live: metrics.source_count(live, DAY),
    ),
    "stream_cmp_hashtag": _stream_cmp(
        "hashtag", topn.top_hashtags, lambda live: metrics.hashtag_count(live, DAY, more_than=0)
    ),
    "stream_cmp_word": _stream_cmp(
        "word", topn.top_words,
        lambda live, words: metrics.word_count(live, HOUR, more_than=0, among=words),
        texts=True, among=True,
    ),
    "stream_loaded_avg_retweets": _stream_cmp(
        "avg_retweets", metrics.avg_retweets, lambda live: metrics.avg_retweets(live, DAY),
        loaded=(["topic"], "retweets"),
    ),
    "stream_loaded_avg_length": _stream_cmp(
        "avg_length", metrics.avg_length, lambda live: metrics.avg_length(live, HOUR), texts=True,
        loaded=(["topic"], "length"),
    ),
    "stream_loaded_total_count": _stream_cmp(
        "total_count",
        lambda stored: baselines.per_window(metrics.total_count(stored), BASELINE_WINDOWS),
        lambda live: metrics.total_count(live, DAY),
        loaded=(["topic", "tweet_type"], "cnt"),
    ),
    "stream_loaded_source": _stream_cmp(
        "source",
        lambda stored: baselines.per_window(topn.top_sources(stored), BASELINE_WINDOWS),
        lambda live: metrics.source_count(live, DAY),
        loaded=(["source", "topic"], "cnt"),
    ),
    "stream_widths": stream_widths,
    "stream_pred_avg_retweets": stream_pred_avg_retweets,
    "stream_pred_avg_length": stream_pred_avg_length,
    "stream_pred_retweets_followers": stream_pred_retweets_followers,
}
