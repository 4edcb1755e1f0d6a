import json
import random

import pytest
from helpers import at, make_posts, ms, raw_line, rows_of, share
from pyspark.sql import functions as F

from postpulse.functions.topics import ELECTION_TOPICS
from postpulse.operators import metrics, predict, topn
from postpulse.operators.sentiment import MAX_INLINE_WORDS
from postpulse.plans import batch, collect, compare, live
from postpulse.plans import predict as predict_job
from postpulse.schema import POST
from postpulse.sources import raw, tables
from postpulse.sources.posts import read_posts, store_posts, stream_posts
from postpulse.streaming.documents import documents
from postpulse.streaming.losses import store_limits, watching
from postpulse.streaming.sinks import save_lines, write_documents
from postpulse.operators.compare import difference
from postpulse.streaming.stateful import (
    of_width,
    stream_difference,
    stream_line,
    stream_popular_user,
    stream_smoothed,
    stream_summaries,
    stream_top_of_windows,
)
from postpulse.streaming.windows import complete, end, event_time, open_ending, run_to_table, wait_for

LEXICON = {"good": 1, "bad": -1}
LAST = 600  # posts of an otherwise empty topic, closing every window before them


def some_posts(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        common = {
            "ts": at(rng.uniform(0, 590)), "topic": rng.choice("abc"),
            "text": rng.choice(["good day", "bad day", "day day", "é😀", ""]),
            "hashtags": rng.choice([[], ["X"], ["x", "Y"]]),
            "source": rng.choice(["", "web", '<a href="u">App</a>', '<a href="v">Other</a>']),
            "screen_name": rng.choice("uvw"), "followers": rng.randint(0, 99),
        }
        if rng.random() < 0.5:
            common = share(
                **common, retweet_screen_name=rng.choice("xyz"),
                retweet_followers=rng.randint(0, 999), retweet_num_retweets=rng.randint(0, 99),
            )
        rows.append(common)
    rows.sort(key=lambda row: row["ts"])
    closing = {"ts": at(LAST), "topic": "z", "text": "x", "hashtags": ["x", "x"]}
    return rows + [closing, share(**closing)]


def feed(spark, rows, folder, files=1):
    """Posts as ``files`` parquet files, oldest first."""
    posts = make_posts(spark, rows).orderBy("ts")
    size = -(-len(rows) // files)
    for i in range(files):
        part = make_posts(spark, rows[i * size : (i + 1) * size])
        part = part.withColumn("id", F.col("id") + i * size)
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return posts


def stream(spark, folder, per_batch=None):
    reader = spark.readStream.schema(POST)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(str(folder))


METRICS = {
    "total_count": metrics.total_count,
    "topic_count": metrics.topic_count,
    "avg_retweets": metrics.avg_retweets,
    "avg_length": metrics.avg_length,
    "retweets_followers": metrics.retweets_followers,
    "hashtag": metrics.hashtag_count,
    "word": metrics.word_count,
    "source": metrics.source_count,
    "sentiment": lambda posts, window: metrics.sentiment_count(posts, LEXICON, window),
    "popular_first": lambda posts, window: metrics.popular_user(posts, window, "first"),
    "popular_top": lambda posts, window: metrics.popular_user(posts, window, "followers"),
}


@pytest.fixture(scope="module")
def fed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed") / "posts"
    rows = some_posts()
    feed(spark, rows, folder, files=3)
    return folder, make_posts(spark, rows)


@pytest.mark.parametrize("name", list(METRICS))
def test_stream_equals_batch(spark, fed, name):
    folder, posts = fed
    streamed = run_to_table(METRICS[name](complete(stream(spark, folder)), "60 seconds"), f"eq_{name}")
    whole = METRICS[name](posts, "60 seconds")
    assert streamed.columns == whole.columns
    assert rows_of(streamed, "*") == rows_of(whole, "*")


@pytest.mark.parametrize("name", ["avg_retweets", "sentiment", "hashtag"])
def test_windows_close_by_posts_that_a_metric_leaves_out(spark, tmp_path, name):
    """The last posts are replies: neither metric counts them."""
    rows = some_posts(60)[:-2] + [{"ts": at(LAST), "topic": "z", "text": "x", "tweet_type": "Reply"}]
    posts = feed(spark, rows, tmp_path / "feed", 3)
    streamed = run_to_table(METRICS[name](event_time(stream(spark, tmp_path / "feed", 1)), "60 seconds"), f"out_{name}")
    whole = METRICS[name](posts, "60 seconds").filter(F.col("window_start") < F.lit(at(LAST)))
    assert rows_of(streamed, "*") == rows_of(whole, "*")


@pytest.mark.parametrize("table", ["events", "documents"])
def test_tables_may_be_files_or_folders(spark, tmp_path, sf_dir, table):
    given = tables.table(spark, sf_dir, table)
    given.repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    for place in (sf_dir, str(tmp_path)):
        found = run_to_table(tables.stream_table(spark, place, table), f"read_{table}")
        assert found.count() == given.count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND|no rows"):
        tables.stream_table(spark, str(tmp_path / "nowhere"), table)


def test_ending_after_several_batches(spark, tmp_path):
    posts = feed(spark, some_posts(100), tmp_path / "feed", 4)
    live_posts = stream(spark, tmp_path / "feed", 1)
    closing = open_ending(live_posts, str(tmp_path / "closing"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def drained():
        counted = metrics.word_count(event_time(live_posts, closing=closing), "60 seconds")
        return run_to_table(counted, "ending", out, checkpoint)

    whole = metrics.word_count(posts, "60 seconds")
    assert drained().count() < whole.count()
    end(spark, closing, live_posts.schema)
    assert rows_of(drained(), "*") == rows_of(whole, "*")


def test_restart_goes_on_without_loss_or_repetition(spark, tmp_path):
    rows = some_posts(120)
    half = len(rows) // 2
    source, out = tmp_path / "in", str(tmp_path / "out")

    def go():
        counted = metrics.total_count(event_time(stream(spark, source)), "60 seconds")
        return run_to_table(counted, "restart", out, str(tmp_path / "cp"))

    feed(spark, rows[:half], source)
    first = go().count()
    feed(spark, rows[half:], source)
    whole = go()
    closed = metrics.total_count(make_posts(spark, rows), "60 seconds").filter(
        F.col("window_start") < F.lit(at(LAST))
    )
    assert 0 < first < whole.count()
    assert rows_of(whole, "*") == rows_of(closed, "*")


def test_late_posts_count_only_within_the_delay(spark, tmp_path):
    source = tmp_path / "in"
    feed(spark, [{"ts": at(10)}, {"ts": at(130)}], source)
    # Spark drops late posts by the watermark of the batch before the last.
    feed(spark, [{"ts": at(131)}], source)
    feed(spark, [{"ts": at(20)}, {"ts": at(100)}, {"ts": at(400)}], source)

    def total(delay, label):
        counted = metrics.topic_count(event_time(stream(spark, source, 1), delay), "60 seconds")
        found = run_to_table(counted, label)
        return rows_of(found, "window_start", "cnt")

    assert total("0 seconds", "late0") == [(at(0), 1), (at(120), 2)]
    assert total("200 seconds", "late200") == [(at(0), 2), (at(60), 1), (at(120), 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_splitting_into_files_does_not_matter(spark, tmp_path, seed):
    """Posts in any order over any files, all within the allowed delay."""
    rng = random.Random(seed)
    rows = some_posts(150, seed)
    far = [{"ts": at(2 * 3600), "topic": "z", "hashtags": ["x"]}]
    posts = make_posts(spark, rows + far)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    while shuffled:
        size = rng.randint(20, 90)
        part, shuffled = shuffled[:size], shuffled[size:]
        make_posts(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    make_posts(spark, far).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    timed = event_time(stream(spark, tmp_path / "in", 2), "20 minutes")
    streamed = run_to_table(metrics.hashtag_count(timed, "60 seconds"), f"split{seed}")
    whole = metrics.hashtag_count(posts, "60 seconds")
    assert rows_of(streamed, "*") == rows_of(whole.filter(F.col("window_start") < F.lit(at(2 * 3600))), "*")


def test_processing_time(spark, fed, tmp_path):
    """Windows go by arrival, the counts keep the posts' time."""
    folder, posts = fed
    live_posts = stream(spark, folder)
    closing = open_ending(live_posts, str(tmp_path / "closing"))
    end(spark, closing, live_posts.schema)
    timed = event_time(live_posts, time_domain="processing", closing=closing)
    for name in ("total_count", "hashtag", "sentiment", "source"):
        counted = run_to_table(METRICS[name](timed, "1 hour"), f"arrival_{name}")
        assert counted.select("window_start").distinct().count() <= 2
        assert counted.filter(F.col("window_start") < F.lit(at(LAST))).isEmpty()
        keys = [c for c in counted.columns if c not in ("window_start", "timestamp", "cnt")]
        merged = counted.groupBy(*keys).agg(F.min("timestamp").alias("timestamp"), F.sum("cnt").alias("cnt"))
        whole = METRICS[name](posts, None) if name != "source" else metrics.source_count(posts, more_than=0)
        assert rows_of(merged, *whole.columns) == rows_of(whole, "*"), name
    first = run_to_table(metrics.popular_user(timed, "365 days"), "arrival_user").first()
    assert ms(0) <= first.timestamp < ms(LAST)
    with pytest.raises(ValueError):
        event_time(stream(spark, folder), time_domain="other")


def test_stateful_predictions_equal_batch(spark, fed):
    folder, posts = fed
    seeds = spark.createDataFrame([("a", 7), ("b", 0)], "topic string, retweets int")
    live_posts = event_time(stream(spark, folder, 1))
    closed = F.col("window_start") < F.lit(at(LAST))
    smoothed = run_to_table(
        stream_smoothed(metrics.avg_retweets(live_posts, "60 seconds"), seeds, "retweets"),
        "pred_retweets", partitions=2,
    )
    expected = predict.predict_avg_retweets(metrics.avg_retweets(posts, "60 seconds"), seeds)
    assert rows_of(smoothed, "*") == rows_of(expected.filter(closed), "*")
    line = run_to_table(
        stream_line(metrics.retweets_followers(live_posts, "60 seconds")), "pred_line", partitions=2
    )
    expected = predict.predict_retweets_followers(metrics.retweets_followers(posts, "60 seconds"))
    assert rows_of(line, "*") == rows_of(expected.filter(closed), "*")


def test_line_is_rounded_alike(spark, tmp_path):
    """Values such as 1.9999995 become the same prediction either way."""
    rng = random.Random(5)
    rows = []
    for minute in range(40):
        rows.append(share(ts=at(minute * 60 + 1), topic="t", retweet_followers=rng.randint(0, 9),
                          retweet_num_retweets=rng.choice([0, 1, 2, 3, 2_000_000])))
    posts = feed(spark, rows, tmp_path / "feed")
    line = run_to_table(stream_line(metrics.retweets_followers(complete(stream(spark, tmp_path / "feed")), "60 seconds")), "line")
    expected = predict.predict_retweets_followers(metrics.retweets_followers(posts, "60 seconds"))
    assert rows_of(line, *expected.columns) == rows_of(expected, "*")
    sums = spark.createDataFrame([(10**7, 19999995, 29999995, 159999995)], "n long, a long, b long, c long")
    for name, cut in (("a", 2), ("b", 3), ("c", 16)):
        given = [F.col(c).cast("decimal(38,0)") for c in ("n", "n", name)]
        line_value = predict.line_at(*given, F.col("n") * 2, F.col(name) * 2, F.lit(1))
        assert sums.select(line_value).first()[0] == cut


# --- sinks -------------------------------------------------------------------


def test_documents(spark):
    rows = spark.createDataFrame([(5, "#né", "a", 2)], "timestamp bigint, hashtag string, topic string, cnt int")
    assert documents(rows, "hashtag").first()[0] == (
        '{"cnt":2,"hashtag":"#n","timestamp":5,"trackterm":"a"}'
    )
    rows = spark.createDataFrame([(5, 1.5, "a", 1)], "timestamp bigint, retweets double, topic string, cnt int")
    assert json.loads(documents(rows, "avg_retweets").first()[0]) == {
        "cnt": 1, "RetweetTweetType": "Retweet", "timestamp": 5, "retweets": 1.5, "trackterm": "a",
    }
    rows = spark.createDataFrame([('a"b', "a", 1, 2)], "source string, topic string, timestamp int, cnt int")
    assert json.loads(documents(rows, "source").first()[0])["source"] == 'a"b'


def test_replayed_batch_replaces_its_documents(spark, tmp_path):
    rows = spark.createDataFrame([(5, "a", 2)], "timestamp bigint, topic string, cnt int")
    write = write_documents(str(tmp_path), [("topic_count", "idx", lambda df: df)])
    for batch_id in (0, 1, 1):
        write(rows, batch_id)
    write(rows.limit(0), 2)
    found = spark.read.text(str(tmp_path / "idx"))
    assert rows_of(found, "batch") == [(0,), (1,)]


def test_collect_keeps_every_line_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.txt").write_text("a\n\nb\n")
    for _ in range(2):
        lines = raw.stream_lines(spark, str(source))
        save_lines(lines, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    (source / "2.txt").write_text("c\n")
    collect.run(raw.stream_lines(spark, str(source), 1), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark.read.text(str(tmp_path / "out")), "value") == [("",), ("a",), ("b",), ("c",)]


# --- jobs ----------------------------------------------------------------------


def raw_feed(seed, n=150, start=0):
    rng = random.Random(seed)
    lines = []
    for i in range(n):
        fields = {
            "id": i, "text": rng.choice(["Trump good trump", "joe bad", "plain warren", "é"]),
            "source": rng.choice(['<a href="u">App</a>', '<a href="v">Oth;er</a>', "web"]),
            "entities": {"hashtags": [{"text": rng.choice(["Vote", "Now"])}]},
            "user": {"id": i % 9, "name": f"N{i % 9}", "screen_name": f"s{i % 9}", "followers_count": i},
        }
        if rng.random() < 0.5:
            fields["retweeted_status"] = {
                "id": 1, "text": fields["text"], "retweet_count": rng.randint(0, 50),
                "user": {"name": "O", "screen_name": "orig", "followers_count": rng.randint(0, 500)},
            }
        lines.append(raw_line(start + i, **fields))
    lines.append('{"limit":{"track":3,"timestamp_ms":"7"}}')
    lines.append("junk")
    return lines


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    (root / "raw").mkdir()
    (root / "raw" / "a.txt").write_text("\n".join(raw_feed(1)) + "\n")
    batch.run_lines(spark, str(root / "raw"), str(root / "batch"), LEXICON)
    (root / "live").mkdir()
    (root / "live" / "a.txt").write_text("\n".join(raw_feed(2, start=3600)) + "\n")
    last = {
        "text": "sanders", "source": '<a href="u">App</a>',
        "entities": {"hashtags": [{"text": "Vote"}]},
    }
    origin = {"id": 1, "text": "sanders", "user": {"screen_name": "o"}}
    closing = [raw_line(7200, **last), raw_line(7200, **last, retweeted_status=origin)]
    (root / "live" / "b.txt").write_text("\n".join(closing) + "\n")
    return root


def test_batch_job_writes_all_results(spark, stored):
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "raw")))
    from postpulse.sources.baselines import read_stored

    expected = batch.results(posts, LEXICON)
    assert set(expected) == set(batch.FILES)
    for metric, rows in expected.items():
        found = read_stored(spark, str(stored / "batch" / batch.FILES[metric]), metric)
        found = found.fillna("")
        assert found.count() > 0, metric
        assert rows_of(found, "*") == rows_of(rows, *found.columns), metric
    assert (stored / "batch" / "limits.csv").exists()
    assert len(list((stored / "batch" / "totalcount.csv").glob("part-*"))) == 1


def test_stored_posts_are_decoded_once_and_streamed_again(spark, stored):
    path = str(stored / "posts")
    for _ in range(2):
        store_posts(live_lines(spark, stored), path, str(stored / "posts_cp")).awaitTermination()
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "live")))
    again = read_posts(spark, path)
    assert rows_of(again.drop("day"), *posts.columns) == rows_of(posts, "*")
    streamed = metrics.total_count(event_time(stream_posts(spark, path, 1)), "60 seconds")
    closed = metrics.total_count(posts, "60 seconds").filter(F.col("window_start") < F.lit(at(7200)))
    assert rows_of(run_to_table(streamed, "stored"), "*") == rows_of(closed, "*")


def test_command_line(spark, stored, monkeypatch):
    from postpulse import __main__ as command

    (stored / "lexicon").write_text("good;1\nbad;-1\n")
    monkeypatch.setattr(command, "build_session", lambda app: spark)

    def call(*words):
        monkeypatch.setattr("sys.argv", ["postpulse", *words])
        command.main()

    source, out = str(stored / "live"), str(stored / "cli")
    lexicon = ["--lexicon", str(stored / "lexicon")]
    call("batch", "--input", source, "--output", f"{out}/batch", *lexicon)
    call("collect", "--input", source, "--output", f"{out}/lines", "--checkpoint", f"{out}/c1")
    call("store", "--input", f"{out}/lines", "--output", f"{out}/posts", "--checkpoint", f"{out}/c2")
    losses = {row.value for row in spark.read.text(f"{out}/posts-aside/losses.csv").collect()}
    assert f"posts;{spark.read.parquet(f'{out}/posts').count()}" in losses
    timing = ["--delay", "0 seconds", "--state-partitions", "2", "--terms", "joe,plain warren"]
    call("compare", "--input", f"posts:{out}/posts", "--output", f"{out}/compared", "--checkpoint",
         f"{out}/c3", "--baselines", f"{out}/batch", "--baseline-windows", "3", *timing)
    found = spark.read.text(f"{out}/compared/comptweetcount-idx").collect()
    assert {json.loads(row.value)["trackterm"] for row in found} <= {"biden", "warren"}
    assert found
    # Stored posts serve the batch job, too; its result is the same.
    call("batch", "--input", f"posts:{out}/posts", "--output", f"{out}/again", *lexicon)
    for name in ("totalcount.csv", "wordcount.csv", "period.csv"):
        again, first = (sorted(spark.read.text(f"{out}/{at_}/{name}").collect()) for at_ in ("again", "batch"))
        assert again == first
    call("batch", "--input", source, "--output", f"{out}/chosen", "--lexicon-table", "--terms", "joe", *lexicon)
    assert {row.value.split(";")[1] for row in spark.read.text(f"{out}/chosen/totalcount.csv").collect()} == {"biden"}
    # Raw lines, decoded once, to the end of the input.
    call("live", "--input", source, "--output", f"{out}/live", "--checkpoint", f"{out}/c4", "--final",
         "--max-files", "1", "--delay", "0 seconds", *lexicon)
    total = sum(json.loads(r.value)["cnt"] for r in spark.read.text(f"{out}/live/tweetcount-idx").collect())
    assert total == spark.read.parquet(f"{out}/c4/posts").count()
    limits = raw.parse_limits(raw.read_lines(spark, source))
    assert rows_of(spark.read.parquet(f"{out}/live/limits"), "*") == rows_of(limits, "*")
    assert "lines;" in "".join(row.value for row in spark.read.text(f"{out}/live/losses.csv").collect())
    call("live", "--input", source, "--output", f"{out}/live2", "--checkpoint", f"{out}/c6", "--final",
         "--remember", "1 day", "--delay", "0 seconds", *lexicon)
    posts = parse_posts_of(spark, source)
    expected = documents(metrics.popular_user_running(posts, "60 seconds"), "popular_user")
    assert rows_of(spark.read.text(f"{out}/live2/popularuser-idx").select("value"), "*") == rows_of(expected, "*")
    call("compare", "--input", f"posts:{out}/posts", "--output", f"{out}/compared2", "--checkpoint",
         f"{out}/c5", "--baselines", f"{out}/batch", "--final", *timing)
    for job, given in (("batch", "kafka://h:1/t"), ("collect", "posts:x"), ("store", "posts:x")):
        with pytest.raises(SystemExit):
            call(job, "--input", given, "--output", out, *(lexicon if job == "batch" else []))


def parse_posts_of(spark, source):
    return raw.parse_posts(raw.read_lines(spark, source))


def live_lines(spark, stored):
    return raw.parse_posts(raw.stream_lines(spark, str(stored / "live"), 1), ELECTION_TOPICS)


def index_rows(spark, path):
    return sorted(json.loads(row.value)["cnt"] if "cnt" in row.value else 0 for row in spark.read.text(str(path)).collect())


def finish(queries):
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None


def test_live_job_fills_every_index(spark, stored):
    out = stored / "live_out"
    finish(live.run(live_lines(spark, stored), str(out), str(stored / "live_cp"), LEXICON,
                    delay="0 seconds", partitions=2))
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "live" / "a.txt")))
    for metric, (index, operator) in {
        "total_count": ("tweetcount-idx", metrics.total_count),
        "topic_count": ("counttrackterms-idx", metrics.topic_count),
        "avg_retweets": ("avgretweetscount-idx", metrics.avg_retweets),
        "avg_length": ("tweetlength-idx", metrics.avg_length),
        "retweets_followers": ("retweetsfollowers-idx", metrics.retweets_followers),
        "hashtag": ("hashtagcount-idx", metrics.hashtag_count),
        "word": ("wordcount-idx", metrics.word_count),
        "source": ("sourcecount-idx", metrics.source_count),
        "sentiment": ("sentiment-idx", METRICS["sentiment"]),
        "popular_user": ("popularuser-idx", METRICS["popular_first"]),
    }.items():
        expected = documents(operator(posts, "60 seconds"), metric)
        found = spark.read.text(str(out / index)).select("value")
        assert rows_of(found, "value") == rows_of(expected, "value"), metric


def test_compare_job(spark, stored):
    out = stored / "compare_out"
    finish(compare.run(live_lines(spark, stored), str(stored / "batch"), 2, str(out),
                       str(stored / "compare_cp"), delay="0 seconds", partitions=2))
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "live" / "a.txt")))
    base = compare.load_baselines(spark, str(stored / "batch"), 2)
    from postpulse.operators import compare as op

    live_total = metrics.total_count(posts, "60 seconds")
    expected = documents(op.compare_total_count(live_total, base["total_count"]), "total_count")
    found = spark.read.text(str(out / "comptweetcount-idx"))
    assert rows_of(found, "value") == rows_of(expected, "value")
    words = metrics.word_count(posts, "60 seconds", more_than=0)
    expected = documents(op.compare_word(words, base["word"]), "word")
    assert rows_of(spark.read.text(str(out / "compwordcount-idx")), "value") == rows_of(expected, "value")
    for index in ("compsourcecount-idx", "comphashtagcount-idx", "comptweetlength-idx", "compavgretweetscount-idx"):
        assert index_rows(spark, out / index), index


def test_compare_job_with_loaded_baselines(spark, stored):
    out = stored / "loaded_out"
    finish(compare.run(live_lines(spark, stored), str(stored / "batch"), 2, str(out),
                       str(stored / "loaded_cp"), delay="0 seconds", partitions=2, in_state=True))
    for index in ("comptweetcount-idx", "compsourcecount-idx", "comptweetlength-idx", "compavgretweetscount-idx",
                  "compwordcount-idx"):
        joined = spark.read.text(str(stored / "compare_out" / index))
        assert rows_of(spark.read.text(str(out / index)), "value") == rows_of(joined, "value")


def test_live_job_with_wider_windows(spark, stored):
    out, cp = stored / "wider_out", stored / "wider_cp"
    lines = live_lines(spark, stored)
    closing = open_ending(lines, str(cp / "closing"))
    end(spark, closing, lines.schema)
    finish(live.run(lines, str(out), str(cp), LEXICON, delay="0 seconds", partitions=2,
                    closing=closing, wider=["5 minutes"]))
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "live")))
    for suffix, width in (("", "60 seconds"), ("-5-minutes", "5 minutes")):
        expected = documents(metrics.total_count(posts, width), "total_count")
        found = spark.read.text(str(out / f"tweetcount-idx{suffix}"))
        assert rows_of(found, "value") == rows_of(expected, "value")
        assert index_rows(spark, out / f"avgretweetscount-idx{suffix}")


def test_predict_job(spark, stored):
    out = stored / "predict_out"
    finish(predict_job.run(live_lines(spark, stored), str(stored / "batch"), str(out),
                           str(stored / "predict_cp"), delay="0 seconds", partitions=2))
    posts = raw.parse_posts(raw.read_lines(spark, str(stored / "live" / "a.txt")))
    base = compare.load_baselines(spark, str(stored / "batch"), 2)
    expected = predict.predict_avg_length(metrics.avg_length(posts, "60 seconds"), base["avg_length"])
    found = spark.read.text(str(out / "predtweetlength-idx"))
    assert rows_of(found, "value") == rows_of(documents(expected, "avg_length"), "value")
    for index in ("predavgretweetscount-idx", "predretweetsfollowers-idx"):
        assert index_rows(spark, out / index)
    assert ms(0) == 1704067200000


def by_hand(rows, width=60):
    """Of each window's first post the record its user was first seen with."""
    firsts, windows = {}, {}
    for i, row in enumerate(rows):
        prefix = "retweet_" if row.get("retweet") else ""
        user = (row.get(f"{prefix}screen_name", "a" if not prefix else ""), row.get(f"{prefix}followers", 0))
        at_ = (row["ts"], i)
        firsts.setdefault(user[0], (at_, user[1]))
        firsts[user[0]] = min(firsts[user[0]], (at_, user[1]))
        start = int((row["ts"] - at(0)).total_seconds() // width)
        windows[start] = min(windows.get(start, (at_, user[0])), (at_, user[0]))
    return sorted((start, handle, firsts[handle][1]) for start, (_, handle) in windows.items())


def _running(df):
    start = (F.unix_seconds("window_start") - F.lit(int(ms(0) / 1000))) / 60
    return rows_of(df, start.cast("int").alias("w"), "screen_name", "followers")


def test_running_first_record_over_several_batches(spark, tmp_path):
    """The record is that of a handle's first post in any window, also when
    that came in an earlier micro-batch, and after a restart."""
    rows = some_posts(300, seed=5)[:-2]
    feed(spark, rows, tmp_path / "in", files=4)
    expected = by_hand(rows)
    assert _running(metrics.popular_user_running(make_posts(spark, rows), "60 seconds")) == expected
    assert len({w for w, _, _ in expected}) == 10

    posts = stream(spark, tmp_path / "in", 1)
    closing = open_ending(posts, str(tmp_path / "closing"))
    args = ("running", str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    timed = event_time(posts, closing=closing)
    found = run_to_table(stream_popular_user(timed, "60 seconds"), *args)
    assert _running(found) == expected[: found.count()] and 0 < found.count() < 10
    end(spark, closing, posts.schema)
    assert _running(run_to_table(stream_popular_user(timed, "60 seconds"), *args)) == expected


def test_handles_are_forgotten(spark, tmp_path):
    """A handle that stays away longer than it is kept is new again; one that
    keeps posting isn't."""
    def post(seconds, handle, followers):
        return {"ts": at(seconds), "screen_name": handle, "followers": followers}

    for i, part in enumerate(
        ([post(0, "u", 1), post(5, "v", 10)], [post(100, "v", 11)], [post(190, "v", 12)], [post(400, "w", 5)],
         [post(500, "u", 2)], [post(560, "v", 13)])
    ):
        rows = make_posts(spark, part).withColumn("id", F.col("id") + 10 * i)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    timed = event_time(stream(spark, tmp_path / "in", 1))
    found = run_to_table(stream_popular_user(timed, "60 seconds", keep="100 seconds"), "kept", str(tmp_path / "out"))
    assert _running(found) == [(0, "u", 1), (1, "v", 10), (3, "v", 10), (6, "w", 5), (8, "u", 2)]


LOST = [
    '{"limit":{"track":12,"timestamp_ms":"1572203359000"}}', '{"limit":{"track":1}}', "", "{}", '{"created_at":"Sun Oct 27',
    '{"created_at":"yesterday","id":5,"user":{"id":1}}', '{"created_at":"Sun Oct 27 19:09:19 +0000 2019","id":1}',
    '{"id":1,"created_at":"Sun Oct 27 19:09:19 +0000 2019","user":{"id":1}}',
]


def test_lost_lines_are_counted(spark, tmp_path):
    """In one pass, over a bounded input and over micro-batches."""
    (tmp_path / "in").mkdir()
    shared = raw_line(2, retweeted_status={"id": 2, "text": "x"})  # of a post without a user
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join([*LOST, raw_line(i), shared]) + "\n")
    expected = {"lines": 10, "posts": 1, "limits": 1, "broken": 1, "no_user": 2, "no_date": 1, "others": 4}
    expected = {fate: 3 * count for fate, count in expected.items()}
    counts = raw.LineCounts()
    posts = raw.parse_posts(raw.read_lines(spark, str(tmp_path / "in")), counts=counts)
    assert posts.count() == 3 and counts.get() == expected

    def drained():
        with watching(spark, raw.LineCounts("some")) as log:
            lines = raw.stream_lines(spark, str(tmp_path / "in"), 1)
            query = store_posts(raw.parse_posts(lines, counts=log.counts), str(tmp_path / "out"), str(tmp_path / "cp"), files_per_day=2)
            limits = store_limits(lines, str(tmp_path / "limits"), str(tmp_path / "cp-limits"))
            wait_for([query, limits])
            assert query.lastProgress["batchId"] >= 2
            return log.after(query)

    assert drained() == expected
    (tmp_path / "in" / "4.txt").write_text("\n".join(LOST))
    again = drained()
    assert again["lines"] == 8 and again["limits"] == 1 and again["posts"] == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert rows_of(spark.read.parquet(str(tmp_path / "limits")), "*") == [(12, 1572203359000)] * 4


def test_a_failing_query_stops_the_others(spark, tmp_path):
    feed(spark, some_posts(20), tmp_path / "in")

    def fail(batch, number):
        raise ValueError("broken sink")

    def start(name, write, trigger):
        writer = stream(spark, tmp_path / "in").writeStream.queryName(name).foreachBatch(write)
        return writer.option("checkpointLocation", str(tmp_path / name)).trigger(**trigger).start()

    endless = start("endless", lambda batch, number: None, {"processingTime": "1 second"})
    failing = start("failing", fail, {"processingTime": "1 second"})
    with pytest.raises(Exception, match="broken sink"):
        wait_for([endless, failing])
    assert not endless.isActive and not failing.isActive
    wait_for([start("drained", lambda batch, number: None, {"availableNow": True})])


def test_a_lexicon_of_any_size_serves_a_stream(spark, tmp_path):
    """Over several micro-batches, posts that are alike among them."""
    rows = some_posts(120, seed=8)[:-2]
    rows = sorted(rows + rows[:15], key=lambda row: row["ts"])
    posts = feed(spark, rows, tmp_path / "in", files=3)
    again = make_posts(spark, rows[:4])  # alike in all columns
    again.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    posts = posts.unionByName(again)
    large = {f"word{i}": 1 for i in range(20_000)} | LEXICON
    assert len(large) > MAX_INLINE_WORDS
    lexicon = spark.createDataFrame(list(large.items()), "word string, weight int")
    whole = rows_of(metrics.sentiment_count(posts, LEXICON, "60 seconds"), "*")
    assert rows_of(metrics.sentiment_count(posts, large, "60 seconds"), "*") == whole
    for name, given in (("dict", large), ("table", lexicon)):
        live_posts = stream(spark, tmp_path / "in")
        closing = open_ending(live_posts, str(tmp_path / f"closing_{name}"))
        timed = event_time(live_posts, closing=closing)
        args = (f"lexicon_{name}", str(tmp_path / name), str(tmp_path / f"cp_{name}"))
        counted = metrics.sentiment_count(timed, given, "60 seconds")
        assert run_to_table(counted, *args).count() < len(whole)
        end(spark, closing, live_posts.schema)
        assert rows_of(run_to_table(metrics.sentiment_count(timed, given, "60 seconds"), *args), "*") == whole


@pytest.mark.parametrize("item", ["word", "hashtag", "source"])
def test_rankings_of_live_windows_equal_batch(spark, tmp_path, item):
    """Ties and several micro-batches; windows come out as they close."""
    rows = some_posts(200, seed=9)[:-2]
    posts = feed(spark, rows, tmp_path / "in", files=3)
    live_posts = stream(spark, tmp_path / "in", 1)
    closing = open_ending(live_posts, str(tmp_path / "closing"))
    ranked = stream_top_of_windows(event_time(live_posts, closing=closing), item, "60 seconds", 2)
    args = ("ranked", str(tmp_path / "out"), str(tmp_path / "cp"))
    whole = rows_of(topn.top_of_windows(posts, item, "60 seconds", 2), "window_start", "timestamp", item, "topic", "cnt")
    some = run_to_table(ranked, *args)
    assert 0 < some.count() < len(whole)
    end(spark, closing, live_posts.schema)
    assert rows_of(run_to_table(ranked, *args), "window_start", "timestamp", item, "topic", "cnt") == whole


def _in_two_runs(spark, tmp_path, derive):
    """Rows after a run that leaves windows open, and after the one that closes them."""
    rows = some_posts(300, seed=11)[:-2]
    posts = feed(spark, rows, tmp_path / "in", files=3)
    live_posts = stream(spark, tmp_path / "in", 1)
    closing = open_ending(live_posts, str(tmp_path / "closing"))
    derived = derive(event_time(live_posts, closing=closing))
    args = ("derived", str(tmp_path / "out"), str(tmp_path / "cp"))
    first = run_to_table(derived, *args).collect()
    end(spark, closing, live_posts.schema)
    return posts, first, run_to_table(derived, *args)


def test_widths_from_one_state_equal_batch(spark, tmp_path):
    widths = ["30 seconds", "2 minutes", "5 minutes"]
    posts, first, found = _in_two_runs(spark, tmp_path, lambda timed: stream_summaries(timed, widths))
    assert {row["width"] for row in first} == set(widths)
    assert len(first) < found.count()
    for width in widths:
        own = of_width(found, width)
        for derive in (metrics.total_count_of, metrics.avg_retweets_of, metrics.avg_length_of,
                       metrics.retweets_followers_of, metrics.topic_count_of):
            expected = derive(metrics.topic_summary(posts, width))
            assert rows_of(derive(own), *expected.columns) == rows_of(expected, "*"), (width, derive.__name__)


def test_widths_must_be_multiples(spark, tmp_path):
    feed(spark, some_posts(5), tmp_path / "in")
    with pytest.raises(ValueError, match="multiples"):
        stream_summaries(event_time(stream(spark, tmp_path / "in")), ["60 seconds", "90 seconds"])


@pytest.mark.parametrize("keys", [["topic"], ["topic", "tweet_type"]])
def test_loaded_baselines_equal_a_join(spark, tmp_path, keys):
    """A restart in the middle; keys without a baseline give nothing."""
    stored = spark.createDataFrame(
        [("a", "Retweet", 3), ("b", "Original Tweet", 0), ("q", "Reply", 9), ("c", "Retweet", None)],
        "topic string, tweet_type string, cnt int",
    ).select(*keys, "cnt")

    def live(rows):
        return metrics.topic_count(rows, "60 seconds") if keys == ["topic"] else metrics.total_count(rows, "60 seconds")

    posts, first, found = _in_two_runs(
        spark, tmp_path, lambda timed: stream_difference(live(timed), stored, keys, "cnt")
    )
    expected = difference(live(posts), stored.dropna(), keys, "cnt")
    assert 0 < len(first) < found.count()
    assert rows_of(found, *expected.columns) == rows_of(expected, "*")
    assert found.schema["cnt"].dataType == expected.schema["cnt"].dataType
