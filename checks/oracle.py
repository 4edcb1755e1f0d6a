"""The registered queries again, as SQL over the same tables.

Times are floored to milliseconds; DuckDB's own ``epoch_ms`` rounds, so it is
used on whole milliseconds only.
"""

from __future__ import annotations

SPLIT = "2024-01-16 00:00:00"
EVENT_SPLIT = f"TIMESTAMP '{SPLIT}'"
# The middle of the documents' id range, as a time.
DOC_MIDDLE = (
    "(SELECT TIMESTAMP '2024-01-01 00:00:00' "
    "+ to_minutes(CAST((min(doc_id) + max(doc_id)) // 2 AS INTEGER)) FROM documents)"
)
LEXICON = {
    "the": 1, "that": 2, "la": 1, "und": 1, "with": 2, "est": 1,
    "of": -1, "de": -1, "die": -1, "was": -2, "not": -2, "que": -1, "and": -1, "der": 1,
}

# Fixed values, as in postpulse/functions/text.py: stop words, the characters
# that cleaning keeps, the source anchor.
STOP = (
    "'a','be','to','i','am','of','it','t','s','and','in','the','is','that','an','on','https',"
    "'co','this','','so','have','they','what','at','by','m','are','has','me','re','he','for',"
    "'you','with'"
)
CLEAN = r"regexp_replace(text, '[^\p{L}\p{N}\p{Z}\p{Sm}\p{Sc}\p{Sk}\p{Pi}\p{Pf}\p{Pc}\p{Mc}\p{Cf}\p{Cs}]', '', 'g')"
TOPIC = """CASE WHEN contains(lower(text), 'sch') THEN 'alpha'
     WHEN contains(lower(text), 'que') THEN 'beta'
     WHEN contains(lower(text), 'ment') THEN 'gamma'
     WHEN contains(lower(text), 'tion') THEN 'delta' ELSE 'other' END"""
ANCHOR = r"""regexp_full_match(source, '<a href="([^"]+)"([^>]*)>(.+?)</a>')"""
APP = r"""regexp_extract(source, '^<a href="([^"]+)"([^>]*)>(.+?)</a>$', 3)"""

POSTS = f"""
labelled AS (SELECT doc_id, lang, source AS doc_source, {TOPIC} AS topic FROM documents),
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         event_id % (SELECT count(*) FROM documents) AS doc_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'Retweet'
              WHEN event_type = 'error' THEN 'Reply' ELSE 'Original Tweet' END AS tweet_type
  FROM events),
posts AS (
  SELECT event_id AS id, ts, epoch_us(ts) // 1000 AS ms, topic, tweet_type,
         tweet_type = 'Retweet' AS retweet,
         CASE k % 3 WHEN 0 THEN [] WHEN 1 THEN [upper(lang)]
                    ELSE [upper(lang), doc_source] END AS hashtags,
         CASE WHEN k % 10 = 0 THEN '' WHEN k % 10 = 1 THEN 'web' ELSE
           '<a href="https://x.example/' || doc_source || '" rel="nofollow">' || doc_source || '</a>'
         END AS source,
         CASE WHEN tweet_type = 'Retweet' THEN 'Author u' || (user_id * 7 % 150)
              ELSE 'User ' || user_id END AS account_name,
         CASE WHEN tweet_type = 'Retweet' THEN 'u' || (user_id * 7 % 150)
              ELSE 'u' || user_id END AS screen_name,
         CASE WHEN tweet_type = 'Retweet' THEN k * 100 + user_id
              ELSE user_id * 10 + k END AS followers,
         CASE WHEN tweet_type = 'Retweet' THEN 'https://x.example/img/u' || (user_id * 7 % 150)
              ELSE 'https://x.example/img/' || user_id END AS img_url,
         CASE WHEN tweet_type = 'Retweet' THEN CAST(floor(value * 10) AS BIGINT) ELSE 0 END AS rt,
         CASE WHEN tweet_type = 'Retweet' THEN k * 100 + user_id ELSE 0 END AS rf
  FROM ev JOIN labelled USING (doc_id))"""

DOCS = f"""
docs AS (
  SELECT doc_id AS id, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS ts,
         epoch_ms(TIMESTAMP '2024-01-01 00:00:00') + doc_id * 60000 AS ms,
         {TOPIC} AS topic, text, lang, source, n_chars,
         CASE doc_id % 3 WHEN 0 THEN 'Retweet' WHEN 1 THEN 'Reply' ELSE 'Original Tweet' END
           AS tweet_type
  FROM documents)"""

TURNS = f"""
docs AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn) AS ts,
         epoch_ms(TIMESTAMP '2024-01-01 00:00:00') + (conv_id * 3600 + turn) * 1000 AS ms,
         {TOPIC} AS topic, coalesce(text, '') AS text, role AS source,
         CASE WHEN turn = 0 THEN 'Original Tweet' ELSE 'Reply' END AS tweet_type
  FROM conversations)"""

TAGS = "tags AS (SELECT ts, ms, topic, '#' || lower(unnest(hashtags)) AS hashtag FROM posts)"
WORDS = rf"""words AS (
  SELECT * FROM (
    SELECT ts, ms, topic, unnest(string_split_regex(lower(text), '\W+')) AS word FROM docs)
  WHERE word NOT IN ({STOP}))"""
APPS = f"apps AS (SELECT ts, ms, topic, {APP} AS source FROM posts WHERE {ANCHOR})"
SENTIMENT = rf"""scored AS (
  SELECT ts, ms, topic, c, coalesce(list_sum(list_transform(
           string_split_regex(lower(c), '\W+'),
           lambda w: CASE {" ".join(f"WHEN w = '{w}' THEN {n}" for w, n in LEXICON.items())} ELSE 0 END)), 0)
         AS score
  FROM (SELECT *, {CLEAN} AS c FROM docs WHERE text <> '' AND tweet_type = 'Original Tweet')),
labels_of AS (
  SELECT ts, ms, topic, CASE WHEN trim(c) = '' THEN 'ERROR' WHEN score > 0 THEN 'POSITIVE'
         WHEN score < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment FROM scored)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _bucket(width: str) -> str:
    return f"epoch_ms(time_bucket(INTERVAL '{width}', ts))"


def _counts(source: str, keys: str, having: int = 0, width: str = "") -> str:
    start = f"{_bucket(width)} AS window_start, " if width else ""
    group = f"{_bucket(width)}, {keys}" if width else keys
    return (
        f"SELECT {start}min(ms) AS timestamp, {keys}, count(*) AS cnt FROM {source} "
        f"GROUP BY {group} HAVING count(*) > {having}"
    )


HOUR_MS, DAY_MS = 3_600_000, 86_400_000


def _win_retweets(width: str, span: int) -> str:
    return (
        f"SELECT {_bucket(width)} AS window_start, {_bucket(width)} + {span} AS timestamp, "
        "CAST(sum(rt) AS DOUBLE) / count(*) AS retweets, topic, CAST(1 AS INTEGER) AS cnt "
        f"FROM posts WHERE retweet GROUP BY {_bucket(width)}, topic"
    )


def _win_length(width: str, span: int) -> str:
    return (
        f"SELECT {_bucket(width)} AS window_start, {_bucket(width)} + {span} AS timestamp, "
        "CAST(sum(length(text)) // count(*) AS INTEGER) AS length, topic, CAST(1 AS INTEGER) AS cnt "
        "FROM docs WHERE text <> '' AND tweet_type = 'Original Tweet' "
        f"GROUP BY {_bucket(width)}, topic"
    )


def _win_followers(width: str, span: int) -> str:
    return (
        f"SELECT {_bucket(width)} AS window_start, {_bucket(width)} + {span} AS timestamp, "
        "CAST(sum(rf) // count(*) AS BIGINT) AS followers, "
        "CAST(sum(rt) // count(*) AS INTEGER) AS retweets, topic, CAST(1 AS INTEGER) AS cnt "
        f"FROM posts WHERE retweet GROUP BY {_bucket(width)}, topic"
    )


def _users(order: str) -> str:
    return (
        f"SELECT {_bucket('1 day')} AS window_start, "
        f"arg_min(ms, {order}) AS timestamp, arg_min(account_name, {order}) AS account_name, "
        f"arg_min(screen_name, {order}) AS screen_name, arg_min(followers, {order}) AS followers, "
        f"arg_min(img_url, {order}) AS img_url FROM posts GROUP BY {_bucket('1 day')}"
    )


FIRST = "{'t': ts, 'i': id}"
# The first record of each handle, met by the first post of each window.
RUNNING = (
    f"SELECT w.window_start, f.timestamp, f.account_name, f.screen_name, f.followers, f.img_url FROM "
    f"(SELECT {_bucket('1 day')} AS window_start, arg_min(screen_name, {FIRST}) AS handle "
    f"FROM posts GROUP BY {_bucket('1 day')}) w JOIN "
    f"(SELECT screen_name, arg_min(ms, {FIRST}) AS timestamp, arg_min(account_name, {FIRST}) AS account_name, "
    f"arg_min(followers, {FIRST}) AS followers, arg_min(img_url, {FIRST}) AS img_url "
    f"FROM posts GROUP BY screen_name) f ON f.screen_name = w.handle"
)
TOP = "{'f': -followers, 's': screen_name, 't': ts, 'i': id}"

AVG_RETWEETS = (
    "SELECT min(ms) AS timestamp, CAST(sum(rt) // count(*) AS INTEGER) AS retweets, topic, "
    "CAST(1 AS INTEGER) AS cnt FROM posts WHERE retweet GROUP BY topic"
)
AVG_LENGTH = (
    "SELECT min(ms) AS timestamp, CAST(sum(length(text)) // count(*) AS INTEGER) AS length, topic, "
    "CAST(1 AS INTEGER) AS cnt FROM docs WHERE text <> '' AND tweet_type = 'Original Tweet' "
    "GROUP BY topic"
)


def _top(source: str, item: str, n: int, columns: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT min(ms) AS timestamp, {item}, topic, count(*) AS cnt, "
        f"row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, {item}) AS r "
        f"FROM {source} GROUP BY {item}, topic) WHERE r <= {n}"
    )


def _win_top(source: str, item: str, n: int) -> str:
    return (
        f"SELECT * FROM ({_counts(source, f'{item}, topic', 0, '1 day')}) "
        f"QUALIFY row_number() OVER (PARTITION BY window_start, topic ORDER BY cnt DESC, {item}) <= {n}"
    )


def _before(sql: str, split: str, table: str) -> str:
    return sql.replace(f"FROM {table}", f"FROM (SELECT * FROM {table} WHERE ts < {split})")


def _after(sql: str, split: str, table: str) -> str:
    return sql.replace(f"FROM {table}", f"FROM (SELECT * FROM {table} WHERE ts >= {split})")


def _smoothed(series: str, seeds: str, value: str, step: str) -> str:
    return f"""
numbered AS (
  SELECT s.*, CAST(b.{value} AS INTEGER) AS seed,
         row_number() OVER (PARTITION BY s.topic ORDER BY s.window_start) AS r
  FROM ({series}) s JOIN ({seeds}) b ON b.topic = s.topic),
run AS (
  SELECT topic, r, window_start, timestamp, {step.format(p="seed", x=value)} AS p
  FROM numbered WHERE r = 1
  UNION ALL
  SELECT n.topic, n.r, n.window_start, n.timestamp, {step.format(p="run.p", x="n." + value)}
  FROM run JOIN numbered n ON n.topic = run.topic AND n.r = run.r + 1)
SELECT window_start, timestamp, p AS {value}, topic || '#prediction' AS topic,
       CAST(1 AS INTEGER) AS cnt FROM run"""


LINE = """
sums AS (
  SELECT *, count(*) OVER w AS n, coalesce(sum(followers) OVER w, 0) AS f,
         coalesce(sum(retweets) OVER w, 0) AS r,
         coalesce(sum(CAST(followers AS HUGEINT) * followers) OVER w, 0) AS ff,
         coalesce(sum(CAST(followers AS HUGEINT) * retweets) OVER w, 0) AS fr
  FROM ({series})
  WINDOW w AS (PARTITION BY topic ORDER BY window_start
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT window_start, timestamp, followers,
       CAST(CASE WHEN n < 2 OR n * ff - f * f = 0 THEN 0 ELSE trunc(round(
         (CAST(r AS DOUBLE) + CAST(n * fr - f * r AS DOUBLE) / CAST(n * ff - f * f AS DOUBLE)
          * (CAST(n AS DOUBLE) * followers - CAST(f AS DOUBLE))) / CAST(n AS DOUBLE), 6))
       END AS INTEGER) AS retweets,
       topic || '#prediction' AS topic, CAST(1 AS INTEGER) AS cnt
FROM sums"""

ROUNDTRIP = """
SELECT id, ms AS timestamp, topic, tweet_type, text, lang,
       '<a href="https://x.example/' || source || '">' || source || '</a>' AS source,
       'User ' || id AS account_name, 'u' || (id % 150) AS screen_name, n_chars AS followers,
       id % 2 = 0 AS verified,
       CASE WHEN tweet_type = 'Reply' THEN id + 1 ELSE -1 END AS in_reply_to,
       'https://x.example/' || source AS links, upper(lang) || ' ' || source AS hashtags,
       CASE WHEN tweet_type = 'Retweet' THEN id + 1000000 ELSE 0 END AS retweet_id,
       CASE WHEN tweet_type = 'Retweet' THEN source ELSE '' END AS retweet_screen_name,
       CASE WHEN tweet_type = 'Retweet' THEN n_chars % 97 ELSE 0 END AS retweet_num_retweets,
       CASE WHEN tweet_type = 'Retweet' THEN n_chars * 3 ELSE 0 END AS retweet_followers
FROM docs"""

LIMITS = (
    "SELECT CAST(user_id AS INTEGER) AS limited, epoch_us(ts) // 1000 AS timestamp "
    "FROM events WHERE event_type = 'error'"
)

# Views have a date in another form, clicks are cut off; the rest is no post.
LOSSES = """
WITH e AS (SELECT event_type AS kind FROM events), n AS (
  SELECT (SELECT count(*) FROM documents) AS posts, count(*) AS events,
         count(*) FILTER (kind = 'error') AS limits, count(*) FILTER (kind = 'click') AS broken,
         count(*) FILTER (kind = 'view') AS no_date FROM e)
SELECT unnest(['lines', 'posts', 'limits', 'broken', 'no_user', 'no_date', 'others']) AS fate,
       unnest([posts + events, posts, limits, broken, 0, no_date, events - limits - broken - no_date]) AS cnt
FROM n"""

FILTERED = r"""
SELECT id, lang, topic FROM (
  SELECT *, list_concat(string_split_regex(lower(text || ' https://x.example/' || source), '\W+'),
                        [lower(lang), lower(source)]) AS w FROM docs)
WHERE lang IN ('en', 'de', 'fr')
  AND ((list_contains(w, 'der') AND list_contains(w, 'die'))
       OR (list_contains(w, 'the') AND list_contains(w, 'src7'))
       OR id IN (1, 4, 7))"""


def _diff(live: str, base: str, keys: list[str], value: str, columns: str) -> str:
    on = " AND ".join(f"l.{key} = b.{key}" for key in keys)
    kept = ", ".join(
        f"l.{value} - b.{value} AS {value}" if name == value else f"l.{name}"
        for name in columns.split(", ")
    )
    return f"SELECT {kept} FROM ({live}) l JOIN ({base}) b ON {on}"


def _in(live: str, base: str, item: str) -> str:
    return (
        f"SELECT l.* FROM ({live}) l WHERE EXISTS (SELECT 1 FROM ({base}) b "
        f"WHERE b.{item} = l.{item} AND b.topic = l.topic)"
    )


def _json(sql: str, fields: list[tuple[str, str, bool]]) -> str:
    """Rows as JSON documents: (field, expression, whether it is a text)."""
    parts = [
        f"'\"{name}\":' || " + (f"'\"' || {value} || '\"'" if text else value)
        for name, value, text in fields
    ]
    return "SELECT '{' || " + " || ',' || ".join(parts) + f" || '}}' AS value FROM ({sql})"


def oracle_sql() -> dict[str, str]:
    posts, docs = _with(POSTS), _with(DOCS)
    tags, words, apps = _with(POSTS, TAGS), _with(DOCS, WORDS), _with(POSTS, APPS)
    feelings = _with(DOCS, SENTIMENT)
    total = _counts("posts", "topic, tweet_type")
    total_days = _counts("posts", "topic, tweet_type", 0, "1 day")
    app_days = _counts("apps", "source, topic", 0, "1 day")
    top_sources = _top("apps", "source", 6, "timestamp, source, topic, cnt")
    windows = 15

    def per_window(sql: str, keys: str) -> str:
        return f"SELECT {keys}, cnt // {windows} AS cnt FROM ({sql})"

    sql = {
        "total_count": posts + total,
        "topic_count": posts + _counts("posts", "topic"),
        "type_rollup": posts
        + "SELECT 'tweetType' AS name_id, min(ms) AS timestamp, tweet_type, count(*) AS cnt "
        "FROM posts GROUP BY tweet_type",
        "avg_retweets": posts + AVG_RETWEETS,
        "avg_length": docs + AVG_LENGTH,
        "retweets_followers": posts
        + "SELECT min(ms) AS timestamp, CAST(sum(rf) // count(*) AS BIGINT) AS followers, "
        "CAST(sum(rt) // count(*) AS INTEGER) AS retweets, topic, CAST(1 AS INTEGER) AS cnt "
        "FROM posts WHERE retweet GROUP BY topic",
        "hashtag_count": tags + _counts("tags", "hashtag, topic", 1),
        "word_count": words + _counts("words", "word, topic", 10),
        "source_count": apps + _counts("apps", "source, topic", 2),
        "sentiment_count": feelings + _counts("labels_of", "sentiment, topic"),
        "sentiment_lexicon_table": feelings + _counts("labels_of", "sentiment, topic"),
        "distinct_users": posts
        + f"SELECT arg_min(ms, {FIRST}) AS timestamp, arg_min(account_name, {FIRST}) AS account_name, "
        f"screen_name, arg_min(followers, {FIRST}) AS followers, arg_min(img_url, {FIRST}) AS img_url "
        "FROM posts GROUP BY screen_name",
        "win_total_count": posts + total_days,
        "win_topic_count": posts + _counts("posts", "topic", 0, "1 day"),
        "win_avg_retweets": posts + _win_retweets("1 day", DAY_MS),
        "win_avg_length": docs + _win_length("1 hour", HOUR_MS),
        "win_retweets_followers": posts + _win_followers("1 day", DAY_MS),
        "win_hashtag_count": tags + _counts("tags", "hashtag, topic", 1, "1 day"),
        "win_word_count": words + _counts("words", "word, topic", 1, "1 hour"),
        "win_source_count": apps + app_days,
        "win_sentiment_count": feelings + _counts("labels_of", "sentiment, topic", 0, "1 hour"),
        "win_popular_first": posts + _users(FIRST),
        "win_popular_top": posts + _users(TOP),
        "win_popular_running": posts + RUNNING,
        "win_topic_count_60s": posts + _counts("posts", "topic", 0, "60 seconds"),
        "word_topn": words + _top("words", "word", 7, "word, topic"),
        "hashtag_topn": tags + _top("tags", "hashtag", 10, "hashtag, topic"),
        "source_topn": apps + top_sources,
        "win_word_topn": words + _win_top("words", "word", 7),
        "win_hashtag_topn": tags + _win_top("tags", "hashtag", 3),
        "win_source_topn": apps + _win_top("apps", "source", 6),
        "total_topn": posts + _top("posts", "tweet_type", 2, "timestamp, topic, tweet_type, cnt"),
        "turn_total_count": _with(TURNS) + _counts("docs", "topic, tweet_type"),
        "turn_win_avg_length": _with(TURNS) + _win_length("1 day", DAY_MS),
        "turn_word_topn": _with(TURNS, WORDS) + _top("words", "word", 7, "word, topic"),
        "turn_win_source_count": _with(TURNS) + _counts("docs", "source, topic", 0, "1 day"),
        "turn_sentiment_count": _with(TURNS, SENTIMENT) + _counts("labels_of", "sentiment, topic"),
        "cmp_avg_retweets": posts
        + _diff(
            _after(_win_retweets("1 day", DAY_MS), EVENT_SPLIT, "posts"),
            _before(AVG_RETWEETS, EVENT_SPLIT, "posts"),
            ["topic"], "retweets", "window_start, timestamp, retweets, topic, cnt",
        ),
        "cmp_avg_length": docs
        + _diff(
            _after(_win_length("1 hour", HOUR_MS), DOC_MIDDLE, "docs"),
            _before(AVG_LENGTH, DOC_MIDDLE, "docs"),
            ["topic"], "length", "window_start, timestamp, length, topic, cnt",
        ),
        "cmp_total_count": posts
        + _diff(
            _after(total_days, EVENT_SPLIT, "posts"),
            per_window(_before(total, EVENT_SPLIT, "posts"), "topic, tweet_type"),
            ["topic", "tweet_type"], "cnt", "window_start, timestamp, topic, tweet_type, cnt",
        ),
        "cmp_source": apps
        + _diff(
            _after(app_days, EVENT_SPLIT, "apps"),
            per_window(_before(top_sources, EVENT_SPLIT, "apps"), "source, topic"),
            ["source", "topic"], "cnt", "window_start, timestamp, source, topic, cnt",
        ),
        "cmp_hashtag": tags
        + _in(
            _after(_counts("tags", "hashtag, topic", 0, "1 day"), EVENT_SPLIT, "tags"),
            _before(_top("tags", "hashtag", 10, "hashtag, topic"), EVENT_SPLIT, "tags"),
            "hashtag",
        ),
        "cmp_word": words
        + _in(
            _after(_counts("words", "word, topic", 0, "1 hour"), DOC_MIDDLE, "words"),
            _before(_top("words", "word", 7, "word, topic"), DOC_MIDDLE, "words"),
            "word",
        ),
        "pred_avg_retweets": "WITH RECURSIVE " + POSTS + ","
        + _smoothed(
            _win_retweets("1 hour", HOUR_MS), AVG_RETWEETS, "retweets",
            "CAST(trunc(({p} + {x}) / 2) AS INTEGER)",
        ),
        "pred_avg_length": "WITH RECURSIVE " + DOCS + ","
        + _smoothed(
            _win_length("1 hour", HOUR_MS), AVG_LENGTH, "length",
            "CAST(({p} + {x}) // 2 AS INTEGER)",
        ),
        "pred_retweets_followers": posts.rstrip() + ","
        + LINE.replace("{series}", _win_followers("1 hour", HOUR_MS)),
        "topic_route": f"SELECT doc_id, {TOPIC} AS topic FROM documents",
        "source_anchor": posts
        + rf"""SELECT id, {APP} AS app,
             regexp_extract(source, '^<a href="([^"]+)"([^>]*)>(.+?)</a>$', 1) AS link
             FROM posts WHERE {ANCHOR}""",
        "text_clean": f"SELECT doc_id, {CLEAN} AS cleaned, "
        r"regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS ascii, "
        "CAST(length(text) AS INTEGER) AS units FROM documents",
        "limit_notices": LIMITS,
        "loss_counts": LOSSES,
        "stream_loss_counts": LOSSES,
        "parse_roundtrip": docs + ROUNDTRIP,
        "source_filter": docs + FILTERED,
        "json_documents": tags
        + "SELECT '{\"cnt\":' || cnt || ',\"hashtag\":\"' || hashtag || '\",\"timestamp\":' || "
        "timestamp || ',\"trackterm\":\"' || topic || '\"}' AS value FROM ("
        + _counts("tags", "hashtag, topic", 1, "1 day")
        + ")",
        "csv_roundtrip": posts + total,
        "stream_limit_notices": LIMITS,
        "stream_total_count": posts + _counts("posts", "topic, tweet_type", 0, "1 hour"),
        "stream_avg_retweets": posts + _win_retweets("1 hour", HOUR_MS),
        "stream_arrival_totals": posts + total,
        "json_avg_retweets": posts
        + _json(
            AVG_RETWEETS,
            [("cnt", "cnt", False), ("RetweetTweetType", "'Retweet'", True), ("timestamp", "timestamp", False),
             ("retweets", "retweets", False), ("trackterm", "topic", True)],
        ),
        "json_avg_length": docs
        + _json(
            AVG_LENGTH,
            [("cnt", "cnt", False), ("timestamp", "timestamp", False), ("length", "length", False),
             ("trackterm", "topic", True)],
        ),
        "json_word": words
        + _json(
            _counts("words", "word, topic", 10),
            [("cnt", "cnt", False), ("timestamp", "timestamp", False), ("word", "word", True),
             ("trackterm", "topic", True)],
        ),
        "json_source": apps
        + _json(
            _counts("apps", "source, topic", 2),
            [("cnt", "cnt", False), ("source", "source", True), ("timestamp", "timestamp", False),
             ("searchTerm", "topic", True)],
        ),
        "json_sentiment": feelings
        + _json(
            _counts("labels_of", "sentiment, topic"),
            [("cnt", "cnt", False), ("tweetType", "'Original Tweet'", True), ("timestamp", "timestamp", False),
             ("sentiment", "sentiment", True), ("trackterm", "topic", True)],
        ),
        "json_popular_user": posts
        + _json(
            _users(FIRST),
            [("follower_count", "followers", False), ("username", "screen_name", True),
             ("accountname", "account_name", True), ("img", "img_url", True), ("timestamp", "timestamp", False)],
        ),
        "stream_documents": posts
        + _json(
            total_days,
            [("cnt", "cnt", False), ("tweetType", "tweet_type", True), ("timestamp", "timestamp", False),
             ("trackterm", "topic", True)],
        )
        + " UNION ALL "
        + _json(
            _counts("posts", "topic", 0, "1 day"),
            [("cnt", "cnt", False), ("trackterm", "topic", True), ("timestamp", "timestamp", False)],
        ),
    }
    tag_days = _counts("tags", "hashtag, topic", 1, "1 day")
    total_json = _json(
        total_days,
        [("cnt", "cnt", False), ("tweetType", "tweet_type", True), ("timestamp", "timestamp", False),
         ("trackterm", "topic", True)],
    )
    tag_json = _json(
        tag_days,
        [("cnt", "cnt", False), ("hashtag", "hashtag", True), ("timestamp", "timestamp", False),
         ("trackterm", "topic", True)],
    )
    indexed = [("tweetcount-idx", total_json), ("hashtagcount-idx", tag_json)]
    sql["stream_index"] = tags + " UNION ALL ".join(
        f"SELECT '{index}' AS \"index\", value FROM ({made}) UNION ALL "
        f"SELECT '{index}' AS \"index\", CAST(count(*) AS VARCHAR) AS value FROM ({made}) HAVING count(*) > 0"
        for index, made in indexed
    )
    sql["json_retweets_followers"] = _json(
        sql["retweets_followers"],
        [("cnt", "cnt", False), ("followers", "followers", False), ("timestamp", "timestamp", False),
         ("retweets", "retweets", False), ("trackterm", "topic", True)],
    )
    # A stream that has ended gives the rows of the batch query.
    streams = "topic_count avg_length retweets_followers hashtag_count word_count source_count "
    for name in (streams + "sentiment_count popular_first popular_top popular_running word_topn hashtag_topn source_topn").split():
        sql[f"stream_{name}"] = sql[f"win_{name}"]
    for name in "avg_retweets avg_length total_count source hashtag word".split():
        sql[f"stream_cmp_{name}"] = sql[f"cmp_{name}"]
    for name in "avg_retweets avg_length total_count source".split():
        sql[f"stream_loaded_{name}"] = sql[f"cmp_{name}"]
    sql["stream_widths"] = posts + " UNION ALL ".join(
        f"SELECT *, '{width}' AS width FROM ({_counts('posts', 'topic, tweet_type', 0, width)})"
        for width in ("60 seconds", "1 hour", "1 day")
    )
    for name in "avg_retweets avg_length retweets_followers".split():
        sql[f"stream_pred_{name}"] = sql[f"pred_{name}"]
    sql["topic_route_many"] = (
        "WITH needles AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS w FROM benchmark), "
        "met AS (SELECT d.doc_id, min(w) AS w FROM documents d JOIN needles ON contains(lower(d.text), w) "
        "GROUP BY d.doc_id) "
        "SELECT doc_id, coalesce(w, 'none') AS topic FROM documents LEFT JOIN met USING (doc_id)"
    )
    sql["source_filter_many"] = (
        "WITH pairs AS (SELECT DISTINCT string_split(unnest(regexp_extract_all(lower(text), "
        "'[a-z]{4,} [a-z]{4,}')), ' ') AS pair FROM benchmark), "
        r"bags AS (SELECT doc_id, string_split_regex(lower(text), '[^\p{L}\p{M}\p{Nd}\p{Pc}]+') AS bag FROM documents) "
        "SELECT doc_id FROM bags WHERE doc_id IN "
        "(SELECT doc_id FROM bags JOIN pairs ON list_has_all(bag, pair))"
    )
    sql["stream_parse_roundtrip"] = sql["parse_roundtrip"]
    sql["stream_sentiment_lexicon_table"] = sql["win_sentiment_count"]
    sql["stream_source_lines"] = sql["parse_roundtrip"]
    return sql
