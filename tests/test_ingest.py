import json

import pytest
from helpers import at, raw_line, rows_of

from postpulse.sources import raw

SHARED = {
    "id": 99, "text": "Bernie speaks", "retweet_count": 12,
    "user": {"name": "Orig", "screen_name": "orig", "followers_count": 1000, "profile_image_url": "i"},
}


def lines(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def parse_one(spark, **fields):
    return raw.parse_posts(lines(spark, raw_line(5, **fields))).first()


def test_plain_post(spark):
    post = parse_one(spark, text="Joe 😀 \"quoted\" \n new", source="web", lang="en")
    assert post.ts == at(5)
    assert post.text == 'Joe 😀 "quoted" \n new'
    assert (post.topic, post.tweet_type, post.retweet) == ("biden", "Original Tweet", False)
    assert (post.account_name, post.screen_name, post.followers) == ("Ann", "ann", 5)
    assert (post.in_reply_to, post.verified, post.source) == (-1, False, "web")
    assert (post.retweet_screen_name, post.retweet_num_retweets, post.retweet_id) == ("", 0, 0)
    assert (post.has_links, post.links, post.has_hashtags, post.hashtags) == (False, "", False, [])
    assert (post.profile_text, post.img_url) == ("", "")


@pytest.mark.parametrize(
    ("reply_to", "kind"), [(5, "Reply"), (0, "Original Tweet"), (-1, "Original Tweet"), (None, "Original Tweet")]
)
def test_post_type_by_reply_id(spark, reply_to, kind):
    assert parse_one(spark, in_reply_to_status_id=reply_to).tweet_type == kind


def test_share_wins_over_reply_and_brings_its_text(spark):
    post = parse_one(spark, text="RT ...", retweeted_status=SHARED, in_reply_to_status_id=5)
    assert (post.tweet_type, post.text, post.topic) == ("Retweet", "Bernie speaks", "sanders")
    assert (post.retweet_id, post.retweet_num_retweets, post.retweet_followers) == (99, 12, 1000)
    assert (post.retweet_account_name, post.retweet_screen_name) == ("Orig", "orig")


def test_quote_is_read_from_the_outer_post(spark):
    assert parse_one(spark, quoted_status={"text": "warren"}).topic == "warren"
    inner = {**SHARED, "text": "plain", "quoted_status": {"text": "warren"}}
    assert parse_one(spark, retweeted_status=inner).topic == "election2020"


def test_entities(spark):
    post = parse_one(
        spark,
        entities={
            "urls": [{"expanded_url": "http://a"}, {"expanded_url": "http://b"}],
            "hashtags": [{"text": "X"}, {"text": "x"}, {"text": "X"}],
        },
    )
    assert (post.has_links, post.links) == (True, "http://a http://b")
    assert (post.has_hashtags, post.hashtags) == (True, ["X", "x", "X"])


BROKEN = [
    "", "{}", "junk", raw_line()[:40], '{"created_at":"never","user":{"id":1}}',
    '{"created_at":"Mon Jan 01 00:00:00 +0000 2024","id":1}',
    json.dumps({"id": 1, "created_at": "Mon Jan 01 00:00:00 +0000 2024", "user": {"id": 1}},
               separators=(",", ":")),
    raw_line(retweeted_status={"id": 1, "text": "x"}),
]


def test_broken_lines_are_dropped(spark):
    assert raw.parse_posts(lines(spark, *BROKEN)).count() == 0
    assert raw.parse_posts(lines(spark, *BROKEN, raw_line())).count() == 1


def test_prefix_can_be_relaxed(spark):
    assert raw.parse_posts(lines(spark, *BROKEN), strict_prefix=False).count() == 1


def test_zone_offset(spark):
    line = '{"created_at":"Mon Jan 01 02:00:00 +0200 2024","id":1,"user":{"id":1}}'
    assert raw.parse_posts(lines(spark, line)).first().ts == at(0)


def test_limit_notices(spark):
    notices = raw.parse_limits(
        lines(
            spark,
            '{"limit":{"track":12,"timestamp_ms":"1572203359000"}}',
            '{"limit":{"track":-1,"timestamp_ms":"1"}}',
            '{"limit":{"track":12,"timestamp_ms":"1572203359000"}} ',
            '{"limit":{"track":99999999999,"timestamp_ms":"1"}}',
            raw_line(),
        )
    )
    assert rows_of(notices, "limited", "timestamp") == [(12, 1572203359000)]


def test_json_is_decoded_once(spark):
    plan = raw.parse_posts(lines(spark, raw_line()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize(
    ("langs", "terms", "users", "kept"),
    [
        ("", "", "", [1, 2, 3, 4]),
        ("en", "", "", [1, 2, 3]),
        ("", "donald trump", "", [1, 3]),
        ("", "donald trump,election2020", "", [1, 2, 3]),
        ("", "", "8", [4]),
        ("", "election2020", "8", [2, 4]),
        ("en,de", "donald trump", "7", [1, 2, 3, 4]),
        ("de", "donald trump", "", []),
    ],
)
def test_source_filter(spark, langs, terms, users, kept):
    other = {"id": 8, "name": "Bob", "screen_name": "bob"}
    posts = raw.parse_posts(
        lines(
            spark,
            raw_line(id=1, lang="en", text="Trump, Donald"),
            raw_line(id=2, lang="en", text="x", entities={"hashtags": [{"text": "Election2020"}]}),
            raw_line(id=3, lang="en", text="donald! trump?"),
            raw_line(id=4, lang="de", text="donaldtrump", user={**other, "id": 8 if users != "7" else 7}),
        )
    )
    assert [r[0] for r in rows_of(raw.select_posts(posts, langs, terms, users), "id")] == kept


@pytest.mark.parametrize(
    ("terms", "kept"),
    [("caf", []), ("café", [1]), ("CAFÉ", [1]), ("straße", [2]), ("c++", [3]), (r"a\eb", [4]), ("日本", [5]), ("日", [])],
)
def test_terms_are_whole_words_in_any_script(spark, terms, kept):
    texts = ["ein Café dort", "die Straße", "learn c++ now", r"odd a\Eb text", "in 日本 heute"]
    posts = raw.parse_posts(lines(spark, *[raw_line(id=i + 1, text=t) for i, t in enumerate(texts)]))
    assert [r[0] for r in rows_of(raw.select_posts(posts, terms=terms), "id")] == kept
