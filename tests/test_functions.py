import math

import pytest
from pyspark.sql import functions as F

from postpulse.functions import text as tx
from postpulse.functions.numeric import saturating_int, truncated_mean
from postpulse.functions.topics import ELECTION_TOPICS, route_topics
from postpulse.operators.sentiment import (
    lexicon_score,
    read_lexicon,
    sentiment_by_join,
    with_sentiment,
)


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("Hello, World", ["hello", "world"]),
        ("snake_case 42x", ["snake_case", "42x"]),
        ("café au lait", ["caf", "au", "lait"]),
        ("the a of https co", []),
        ("", []),
        ("...!", []),
    ],
)
def test_tokens_and_stop_words(spark, text, words):
    df = spark.createDataFrame([(text,)], "v string").select(F.explode(tx.tokens(F.col("v"))).alias("w"))
    assert [r.w for r in df.filter(tx.is_counted_word(F.col("w"))).collect()] == words


def test_stop_word_list():
    assert len(tx.STOP_WORDS) == 36
    assert len(set(tx.STOP_WORDS)) == 35
    assert "" in tx.STOP_WORDS


@pytest.mark.parametrize(("text", "units"), [("abc", 3), ("é", 1), ("😀", 2), ("a😀é", 4), ("", 0)])
def test_utf16_length(spark, text, units):
    assert one(spark, text, tx.utf16_length) == units


@pytest.mark.parametrize(
    ("source", "app"),
    [
        ('<a href="http://x" rel="nofollow">Web App</a>', "Web App"),
        ('<a href="http://x">Web</a>', "Web"),
        ('see <a href="http://x">Web</a>', ""),
        ('<a href="http://x">Web</a> now', ""),
        ('<a href="http://x">Web</a>\n', ""),
        ('<a href="http://x">W\neb</a>', ""),
        ('<a href="http://x"></a>', ""),
        ('<a href="">Web</a>', ""),
        ('<a href="x">one</a><a href="y">two</a>', 'one</a><a href="y">two'),
        ("web", ""),
        ("", ""),
    ],
)
def test_source_anchor(spark, source, app):
    assert one(spark, source, tx.source_apps) == ([app] if app else [])


def test_source_link(spark):
    assert one(spark, '<a href="http://x" rel="n">W</a>', tx.source_links) == ["http://x"]


@pytest.mark.parametrize(
    ("text", "cleaned"),
    [
        ("Hi, there! #tag @me", "Hi there tag me"),
        ("1 + 1 = 2 €", "1 + 1 = 2 €"),
        ("a-b «c» “d”", "ab «c» “d”"),
        ("😀👍", ""),
        ("...", ""),
        ("a\nb\tc", "abc"),
    ],
)
def test_clean_text(spark, text, cleaned):
    assert one(spark, text, tx.clean_text) == cleaned


def test_ascii_only_and_hashtag(spark):
    assert one(spark, "naïve 😀 x", tx.ascii_only) == "nave  x"
    assert one(spark, "TeamX", tx.hashtag) == "#teamx"


@pytest.mark.parametrize(
    ("value", "cut"),
    [
        (2.7, 2), (-2.7, -2), (1e300, 2147483647), (-1e300, -2147483648), (math.nan, 0),
        (math.inf, 2147483647), (None, 0), (0.0, 0),
    ],
)
def test_saturating_int(spark, value, cut):
    assert one(spark, value, saturating_int, "double") == cut


@pytest.mark.parametrize(("total", "n", "mean"), [(7, 2, 3), (-7, 2, -3), (2**40, 1, 2147483647)])
def test_truncated_mean(spark, total, n, mean):
    df = spark.createDataFrame([(total, n)], "t bigint, n bigint")
    assert df.select(truncated_mean(F.col("t"), F.col("n"))).first()[0] == mean


@pytest.mark.parametrize(
    ("text", "quoted", "topic"),
    [
        ("Donald said", None, "trump"),
        ("TRUMP", None, "trump"),
        ("joey", None, "biden"),
        ("Biden", None, "biden"),
        ("bernie", None, "sanders"),
        ("sanders", None, "sanders"),
        ("elizabeth", None, "warren"),
        ("warren", None, "warren"),
        ("#election2020", None, "election2020"),
        ("warren and joe", None, "biden"),
        ("sanders beats trump", None, "trump"),
        ("nothing", "about Warren", "warren"),
        ("so war", "ren starts", "warren"),
        ("nothing", None, "election2020"),
        (None, None, "election2020"),
    ],
)
def test_topic_router(spark, text, quoted, topic):
    df = spark.createDataFrame([(text, quoted)], "t string, q string")
    routed = route_topics(df, ELECTION_TOPICS, F.col("t"), F.col("q"))
    assert routed.first().topic == topic
    assert "_haystack" not in routed.columns


LEXICON = {"good": 2, "fine": 1, "bad": -2, "poor": -1}
SENTENCES = [
    ("good good bad", "POSITIVE"),
    ("bad, fine!", "NEGATIVE"),
    ("fine poor", "NEUTRAL"),
    ("nothing known", "NEUTRAL"),
    ("😀 ...", "ERROR"),
    ("!!!", "ERROR"),
    ("goodbad", "NEUTRAL"),
    ("GOOD", "POSITIVE"),
    ("go-od", "POSITIVE"),
]


@pytest.mark.parametrize(("text", "label"), SENTENCES)
def test_sentiment_label(spark, text, label):
    posts = spark.createDataFrame([(text,)], "text string")
    labelled = with_sentiment(posts, LEXICON)
    assert labelled.columns == ["text", "sentiment"]
    assert labelled.first().sentiment == label


def test_sentiment_by_join_equals_inline(spark):
    posts = spark.createDataFrame(
        [(i, text, "t") for i, (text, _) in enumerate(SENTENCES)], "id bigint, text string, topic string"
    ).withColumn("ts", F.timestamp_seconds(F.col("id")))
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, weight int")
    found = {r.id: r.sentiment for r in sentiment_by_join(posts, lexicon).collect()}
    assert found == {i: label for i, (_, label) in enumerate(SENTENCES)}
    # Rows that share an id are posts of their own, either way.
    twice = posts.unionAll(posts).withColumn("id", F.lit(1))
    counted = sentiment_by_join(twice, lexicon).groupBy("sentiment").count()
    inline = with_sentiment(twice, LEXICON).groupBy("sentiment").count()
    assert sorted(counted.collect()) == sorted(inline.collect())
    # A table that doesn't broadcast gives the same.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(sentiment_by_join(twice, lexicon).groupBy("sentiment").count().collect()) == sorted(
            inline.collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lexicon_limits(spark):
    assert one(spark, "good", lambda c: lexicon_score(c, {})) == 0
    with pytest.raises(ValueError):
        lexicon_score(F.lit("x"), {str(i): 1 for i in range(10_001)})


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "small").write_text("good;2\nbad;-2\n")
    assert read_lexicon(spark, str(tmp_path / "small")) == {"good": 2, "bad": -2}
    (tmp_path / "twice").write_text("good;1\ngood;3\nbad;\n")
    assert read_lexicon(spark, str(tmp_path / "twice")) == {"good": 3}
    assert read_lexicon(spark, str(tmp_path / "twice"), as_table=True).collect() == [("good", 3)]
    (tmp_path / "large").write_text("".join(f"w{i};{i}\n" for i in range(10_001)))
    # Too large to be inlined: a table, whatever was asked for.
    assert read_lexicon(spark, str(tmp_path / "large")).count() == 10_001
    assert read_lexicon(spark, str(tmp_path / "large"), as_table=True).count() == 10_001


def test_many_weights(spark):
    lexicon = {f"w{i}": i for i in range(3000)}
    assert one(spark, "w2999 w7 other w7", lambda c: lexicon_score(c, lexicon)) == 3013
