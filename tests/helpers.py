"""Hand-made posts."""

from __future__ import annotations

import datetime as dt
import json

from postpulse.schema import POST

FIELDS = [line.strip().rstrip(",").split(" ", 1)[0] for line in POST.strip().splitlines()]
BLANK = {
    "id": 0, "ts": dt.datetime(2024, 1, 1), "topic": "a", "tweet_type": "Original Tweet",
    "retweet": False, "text": "x", "lang": "en", "source": "", "account_name": "A",
    "screen_name": "a", "user_id": 1, "followers": 0, "verified": False, "img_url": "",
    "profile_text": "", "profile_location": "", "in_reply_to": -1, "has_links": False,
    "links": "", "has_hashtags": False, "hashtags": [], "favorite_count": 0, "retweet_count": 0,
    "retweet_id": 0, "retweet_account_name": "", "retweet_screen_name": "",
    "retweet_num_retweets": 0, "retweet_followers": 0, "retweet_img_url": "",
}


def at(seconds: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def ms(seconds: float) -> int:
    return 1704067200000 + int(seconds * 1000)


def share(**fields) -> dict:
    return {"tweet_type": "Retweet", "retweet": True, **fields}


def make_posts(spark, rows: list[dict]):
    data = [tuple({**BLANK, "id": i, **row}[name] for name in FIELDS) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, POST)


def raw_line(seconds: float = 0, **fields) -> str:
    created = at(seconds).strftime("%a %b %d %H:%M:%S +0000 %Y")
    user = {"id": 7, "name": "Ann", "screen_name": "ann", "followers_count": 5}
    return json.dumps(
        {"created_at": created, "id": 1, "text": "hi", "user": user, **fields},
        ensure_ascii=False, separators=(",", ":"),
    )


def rows_of(df, *columns) -> list[tuple]:
    return sorted(tuple(row) for row in df.select(*columns).collect())
