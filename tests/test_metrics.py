import datetime as dt

import pytest
from helpers import at, make_posts, ms, rows_of, share
from pyspark.sql import functions as F

from postpulse.operators import compare, metrics, topn
from postpulse.schema import ORIGINAL, REPLY, RETWEET
from postpulse.sources.baselines import read_once_per_key, one_per_key, per_window, read_stored, windows_between, windows_covered


def test_total_and_topic_count_and_rollup(spark):
    posts = make_posts(
        spark,
        [
            {"ts": at(3), "topic": "a"},
            {"ts": at(1), "topic": "a"},
            share(ts=at(2), topic="a"),
            {"ts": at(4), "topic": "b", "tweet_type": REPLY},
        ],
    )
    assert rows_of(metrics.total_count(posts), "timestamp", "topic", "tweet_type", "cnt") == [
        (ms(1), "a", ORIGINAL, 2), (ms(2), "a", RETWEET, 1), (ms(4), "b", REPLY, 1),
    ]
    assert rows_of(metrics.topic_count(posts), "timestamp", "topic", "cnt") == [
        (ms(1), "a", 3), (ms(4), "b", 1),
    ]
    assert rows_of(metrics.type_rollup(posts), "tweet_type", "cnt", "name_id") == [
        (ORIGINAL, 2, "tweetType"), (REPLY, 1, "tweetType"), (RETWEET, 1, "tweetType"),
    ]


def test_summary_serves_all_five(spark):
    posts = make_posts(
        spark,
        [
            share(topic="a", retweet_num_retweets=3, retweet_followers=10),
            {"topic": "a", "text": "four"},
            {"topic": "b", "text": ""},
        ],
    )
    for window in (None, "60 seconds"):
        summary = metrics.topic_summary(posts, window)
        for derive, direct in (
            (metrics.total_count_of, metrics.total_count),
            (metrics.topic_count_of, metrics.topic_count),
            (metrics.avg_retweets_of, metrics.avg_retweets),
            (metrics.avg_length_of, metrics.avg_length),
            (metrics.retweets_followers_of, metrics.retweets_followers),
        ):
            derived, whole = derive(summary), direct(posts, window)
            assert derived.columns == whole.columns
            assert rows_of(derived, "*") == rows_of(whole, "*")


def test_windows_add_up_to_the_whole(spark):
    posts = make_posts(
        spark,
        [share(ts=at(20 * i), retweet_num_retweets=i) for i in range(9)]
        + [{"ts": at(25 * i), "text": "x" * i} for i in range(9)],
    )
    whole = metrics.topic_summary(posts)
    merged = metrics.whole_of(metrics.topic_summary(posts, "60 seconds"))
    assert rows_of(merged, *whole.columns) == rows_of(whole, "*")


def test_means_truncate_over_all_and_stay_exact_per_window(spark):
    posts = make_posts(
        spark, [share(retweet_num_retweets=n, retweet_followers=n * 3, ts=at(n)) for n in (1, 2, 2)]
    )
    assert rows_of(metrics.avg_retweets(posts), "timestamp", "retweets", "cnt") == [(ms(1), 1, 1)]
    windowed = metrics.avg_retweets(posts, "60 seconds")
    assert rows_of(windowed, "timestamp", "retweets", "cnt") == [(ms(60), 5 / 3, 1)]
    both = metrics.retweets_followers(posts, "60 seconds")
    assert rows_of(both, "followers", "retweets") == [(5, 1)]


def test_sums_beyond_int(spark):
    posts = make_posts(spark, [share(retweet_num_retweets=2**31 - 1) for _ in range(4)])
    assert metrics.avg_retweets(posts).first().retweets == 2**31 - 1


def test_avg_length_looks_at_filled_originals(spark):
    posts = make_posts(
        spark,
        [
            {"text": "", "ts": at(0)}, {"text": "abc", "ts": at(1)}, {"text": "😀é", "ts": at(2)},
            {"text": "abcd", "ts": at(3)}, share(text="long long"), {"text": "", "topic": "b"},
        ],
    )
    assert rows_of(metrics.avg_length(posts), "timestamp", "length", "topic") == [(ms(1), 3, "a")]


def test_hashtags(spark):
    posts = make_posts(
        spark,
        [
            {"hashtags": ["X", "x"]}, {"hashtags": ["x"], "topic": "b"}, {"hashtags": ["y"]},
            {"hashtags": []},
        ],
    )
    assert rows_of(metrics.hashtag_count(posts), "hashtag", "topic", "cnt") == [("#x", "a", 2)]
    every = metrics.hashtag_count(posts, more_than=0)
    assert rows_of(every, "hashtag", "topic", "cnt") == [
        ("#x", "a", 2), ("#x", "b", 1), ("#y", "a", 1),
    ]


@pytest.mark.parametrize(
    ("window", "uses", "kept"), [(None, 10, 0), (None, 11, 1), ("60 seconds", 1, 0), ("60 seconds", 2, 1)]
)
def test_word_thresholds(spark, window, uses, kept):
    posts = make_posts(spark, [{"text": "Word the"}] * uses)
    assert metrics.word_count(posts, window).count() == kept


@pytest.mark.parametrize(
    ("window", "uses", "kept"), [(None, 2, 0), (None, 3, 1), ("60 seconds", 1, 1)]
)
def test_source_thresholds(spark, window, uses, kept):
    posts = make_posts(spark, [{"source": '<a href="u">App</a>'}] * uses + [{"source": "web"}])
    assert metrics.source_count(posts, window).count() == kept


def test_sentiment_count(spark):
    posts = make_posts(
        spark,
        [{"text": "good"}, {"text": "Good!"}, {"text": "bad"}, {"text": "?!"}, {"text": ""},
         share(text="good")],
    )
    found = metrics.sentiment_count(posts, {"good": 1, "bad": -1})
    assert rows_of(found, "sentiment", "cnt") == [("ERROR", 1), ("NEGATIVE", 1), ("POSITIVE", 2)]


def test_users(spark):
    posts = make_posts(
        spark,
        [
            {"ts": at(5), "screen_name": "u", "followers": 50},
            {"ts": at(1), "screen_name": "u", "followers": 10},
            share(ts=at(2), screen_name="u", retweet_screen_name="v", retweet_followers=70),
            share(ts=at(70), screen_name="u", retweet_screen_name="w", retweet_followers=70),
            {"ts": at(71), "screen_name": "t", "followers": 70},
        ],
    )
    assert rows_of(metrics.distinct_users(posts), "screen_name", "followers", "timestamp") == [
        ("t", 70, ms(71)), ("u", 10, ms(1)), ("v", 70, ms(2)), ("w", 70, ms(70)),
    ]
    first = metrics.popular_user(posts, "60 seconds", "first")
    assert rows_of(first, "window_start", "screen_name") == [(at(0), "u"), (at(60), "w")]
    most = metrics.popular_user(posts, "60 seconds", "followers")
    assert rows_of(most, "window_start", "screen_name") == [(at(0), "v"), (at(60), "t")]


def test_windows_are_half_open(spark):
    posts = make_posts(spark, [{"ts": at(s)} for s in (0, 59.999, 60, 119)])
    windowed = metrics.topic_count(posts, "60 seconds")
    assert rows_of(windowed, "window_start", "timestamp", "cnt") == [
        (at(0), ms(0), 2), (at(60), ms(60), 2),
    ]


def test_invariants_on_tables(spark, sf_dir):
    """Counts of one metric are sums of another's."""
    from postpulse.sources import tables

    posts = tables.posts(spark, sf_dir)
    total = metrics.total_count(posts)
    by_topic = total.groupBy("topic").agg(F.sum("cnt").alias("cnt"))
    assert rows_of(by_topic, "topic", "cnt") == rows_of(metrics.topic_count(posts), "topic", "cnt")
    by_type = total.groupBy("tweet_type").agg(F.sum("cnt").alias("cnt"))
    assert rows_of(by_type, "tweet_type", "cnt") == rows_of(metrics.type_rollup(posts), "tweet_type", "cnt")
    texts = tables.document_posts(spark, sf_dir)
    labels = metrics.sentiment_count(texts, {"the": 1, "of": -1})
    originals = metrics.total_count(texts).filter(F.col("tweet_type") == ORIGINAL)
    assert rows_of(labels.groupBy("topic").agg(F.sum("cnt")), "*") == rows_of(originals, "topic", "cnt")
    ranked = topn.top_sources(posts)
    assert ranked.join(metrics.source_count(posts, more_than=0), ranked.columns).count() == ranked.count()


# --- rankings ----------------------------------------------------------------


def test_top_n_ties_and_short_groups(spark):
    counts = spark.createDataFrame(
        [("b", "x", 2), ("a", "x", 2), ("c", "x", 1), ("a", "y", 1)], "word string, topic string, cnt bigint"
    )
    assert rows_of(topn.top_n(counts, "word", 2), "topic", "word") == [("x", "a"), ("x", "b"), ("y", "a")]
    assert rows_of(topn.top_n(counts, "word", 1), "topic", "word") == [("x", "a"), ("y", "a")]
    assert topn.top_n(counts, "word", 0).count() == 0


def test_top_words_ignore_the_threshold(spark):
    posts = make_posts(spark, [{"text": "once"}, {"text": "twice twice"}])
    assert rows_of(topn.top_words(posts), "word", "topic") == [("once", "a"), ("twice", "a")]


# --- comparisons ---------------------------------------------------------------


def live_counts(spark):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 1, "a", RETWEET, 5), (dt.datetime(2024, 1, 1), 1, "b", RETWEET, 5)],
        "window_start timestamp, timestamp bigint, topic string, tweet_type string, cnt bigint",
    )


def test_difference_drops_unknown_keys_and_can_be_negative(spark):
    base = spark.createDataFrame([("a", RETWEET, 9)], "topic string, tweet_type string, cnt bigint")
    found = compare.compare_total_count(live_counts(spark), base)
    assert found.columns == live_counts(spark).columns
    assert rows_of(found, "topic", "cnt") == [("a", -4)]
    assert compare.compare_total_count(live_counts(spark), base.limit(0)).count() == 0


def test_members(spark):
    live = spark.createDataFrame([("#x", "a", 1), ("#x", "b", 1)], "hashtag string, topic string, cnt bigint")
    top = spark.createDataFrame([("#x", "a"), ("#x", "a")], "hashtag string, topic string")
    assert rows_of(compare.compare_hashtag(live, top), "*") == [("#x", "a", 1)]


def test_repeated_baseline_keys(spark, tmp_path):
    (tmp_path / "s.csv").write_text("1;10;a;1\n2;20;a;1\n3;30;b;1\n")
    stored = read_stored(spark, str(tmp_path / "s.csv"), "avg_retweets")
    assert rows_of(one_per_key(stored, ["topic"], "last"), "topic", "retweets") == [("a", 20), ("b", 30)]
    assert rows_of(one_per_key(stored, ["topic"], "first"), "topic", "retweets") == [("a", 10), ("b", 30)]


def test_first_and_last_go_by_file_and_row(spark, tmp_path):
    # Spark reads the largest file first.
    for name, first, n in (("a", 0, 5), ("b", 100, 900), ("c", 2000, 50)):
        lines = "".join(f"1;{first + i};t;1\n" for i in range(n))
        (tmp_path / f"part-{name}.csv").write_text(lines)
    for keep, expected in (("first", 0), ("last", 2049)):
        found = read_once_per_key(spark, str(tmp_path), "avg_retweets", ["topic"], keep)
        assert rows_of(found, "topic", "retweets") == [("t", expected)]


def test_stored_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text("timestamp;trackterm;count\n5;a;7\n")
    stored = read_stored(spark, str(tmp_path / "s.csv"), "topic_count", header=True)
    assert rows_of(stored, "*") == [(5, "a", 7)]


def test_windows_covered(spark):
    assert windows_covered(make_posts(spark, [{"ts": at(5)}, {"ts": at(185)}, {"ts": at(60)}])) == 3


def test_per_window(spark):
    assert windows_between(1572203359994, 1572216813539) == 224
    base = spark.createDataFrame([("a", 449)], "topic string, cnt bigint")
    assert per_window(base, 224).first().cnt == 2


def test_distinct_users_at_the_edges_of_times_and_ids(spark):
    import datetime as dt

    big = 2**63 - 1
    rows = [
        {"ts": at(5), "id": -big - 1, "screen_name": "u", "followers": 1}, {"ts": at(5), "id": big, "screen_name": "u", "followers": 2},
        {"ts": dt.datetime(1900, 1, 1), "id": big, "screen_name": "v", "followers": 3},
        {"ts": dt.datetime(1900, 1, 1), "id": 0, "screen_name": "v", "followers": 4},
        {"ts": at(9), "id": 3, "screen_name": None, "followers": 5}, {"ts": at(8), "id": 4, "screen_name": None, "followers": 6},
        {"ts": at(7), "id": 5, "screen_name": "w", "followers": 7}, {"ts": at(7), "id": 5, "screen_name": "w", "followers": 7},
    ]
    found = metrics.distinct_users(make_posts(spark, rows)).collect()
    assert {(r["screen_name"], r["followers"]) for r in found} == {("u", 1), ("v", 4), (None, 6), ("w", 7)} and len(found) == 4
