"""Raw JSON lines to typed posts and limit notices.

The same functions serve a bounded folder of lines and an endless stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.phrases import MAX_INLINE, any_phrase
from ..functions.topics import ELECTION_TOPICS, TopicRules, route_topics
from ..schema import ORIGINAL, RAW_POST, REPLY, RETWEET

# How a post line starts, and the whole of a limit notice.
POST_PREFIX = '{"cre'
LIMIT_NOTICE = r'\A\{"limit":\{"track":([0-9]+),"timestamp_ms":"([0-9]+)"\}\}\z'
# "Sun Oct 27 19:09:19 +0000 2019" without the weekday, which Spark cannot parse.
CREATED_AT = "MMM dd HH:mm:ss Z yyyy"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Bounded scan of a file or folder of lines."""
    return spark.read.text(path).select("value")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Endless scan of a folder that collectors keep adding files to."""
    reader = spark.readStream.format("text").schema("value STRING")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_topic_lines(spark: SparkSession, **options: str) -> DataFrame:
    """Endless scan of a Kafka topic; needs the connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_limits(lines: DataFrame) -> DataFrame:
    """Limit notices: how many posts the remote end held back, and when."""
    limited, at = (
        F.regexp_extract("value", LIMIT_NOTICE, 1).try_cast("int"),
        F.regexp_extract("value", LIMIT_NOTICE, 2).try_cast("bigint"),
    )
    return (
        lines.filter(F.col("value").startswith('{"limit"'))
        .select(limited.alias("limited"), at.alias("timestamp"))
        .filter(F.col("limited").isNotNull() & F.col("timestamp").isNotNull())
    )


class LineCounts:
    """Counts what becomes of raw lines, in the pass that parses them.

    lines: all; posts: whole ones; limits: notices; broken: what begins like a
    post and can't be decoded; no_user, no_date: posts that lack one, or have
    it in another form; others: all else. A line is one of the last six.

    Over a bounded input ``get`` tells the counts once an action has run. A
    stream reports them with each micro-batch's progress (``of``); see
    ``streaming.losses`` for their sums."""

    FATES = ("lines", "posts", "limits", "broken", "no_user", "no_date", "others")

    def __init__(self, name: str = "lines") -> None:
        self.name = name
        self._observed: dict[str, Observation] = {}

    def label(self, part: str) -> str:
        return f"{self.name}_{part}"

    def _watch(self, rows: DataFrame, part: str, *counts: Column) -> DataFrame:
        if rows.isStreaming:
            return rows.observe(self.label(part), *counts)
        # One pass is observed; a second one would overwrite it.
        self._observed[part] = Observation(self.label(part))
        return rows.observe(self._observed[part], *counts)

    def of_lines(self, lines: DataFrame, prefix: str) -> DataFrame:
        value = F.col("value")
        notice = value.startswith('{"limit"') & value.rlike(LIMIT_NOTICE)
        return self._watch(
            lines, "all", F.count(F.lit(1)).alias("lines"), F.count_if(value.startswith(prefix)).alias("begun"),
            F.count_if(notice).alias("limits"),
        )

    def of_decoded(self, decoded: DataFrame, whole: Column, created: Column) -> DataFrame:
        nothing = F.col("created_at").isNull() & F.col("user").isNull() & F.col("id").isNull()
        whole, dated = F.coalesce(whole, F.lit(False)), created.isNotNull()
        return self._watch(
            decoded, "begun", F.count_if(nothing).alias("broken"), F.count_if(~nothing & ~whole).alias("no_user"),
            F.count_if(whole & ~dated).alias("no_date"), F.count_if(whole & dated).alias("posts"),
        )

    def get(self) -> dict[str, int]:
        return self._named({part: seen.get for part, seen in self._observed.items()})

    def of(self, observed: dict) -> dict[str, int] | None:
        """The counts of one progress report's ``observedMetrics``."""
        parts = {part: observed.get(self.label(part)) for part in ("all", "begun")}
        if None in parts.values():
            return None
        return self._named({part: row.asDict() for part, row in parts.items()})

    def _named(self, parts: dict[str, dict]) -> dict[str, int]:
        found = {name: int(count or 0) for part in parts.values() for name, count in part.items()}
        found["others"] = found["lines"] - found.pop("begun") - found["limits"]
        return {fate: found[fate] for fate in self.FATES}


def parse_posts(
    lines: DataFrame,
    rules: TopicRules = ELECTION_TOPICS,
    strict_prefix: bool = True,
    counts: LineCounts | None = None,
) -> DataFrame:
    """Post rows from raw lines; whatever is not a whole post is dropped, and
    counted where ``counts`` are given.

    A post line must start with its creation date unless ``strict_prefix`` is
    off, in which case any JSON object with a date and a user counts.
    """
    prefix = POST_PREFIX if strict_prefix else "{"
    # Generators evaluate the JSON decoder and the date parser once per line:
    # filters on their output stay above instead of being pushed down with a
    # second copy. A line without a date yields no row.
    lines = counts.of_lines(lines, prefix) if counts else lines
    decoded = lines.filter(F.col("value").startswith(prefix)).select(
        F.inline(F.array(F.from_json("value", RAW_POST)))
    )
    shared = F.col("retweeted_status")
    is_share = shared.isNotNull()
    whole = F.col("user").isNotNull() & (~is_share | F.col("retweeted_status.user").isNotNull())
    created = F.try_to_timestamp(F.col("created_at").substr(F.lit(5), F.length("created_at")), F.lit(CREATED_AT))
    decoded = counts.of_decoded(decoded, whole, created) if counts else decoded
    dated = decoded.filter(whole).select("*", F.explode(F.array_compact(F.array(created))).alias("ts"))
    text = F.when(is_share, F.col("retweeted_status.text")).otherwise(F.col("text"))
    routed = route_topics(dated, rules, text, F.col("quoted_status.text"))
    reply_to = F.coalesce(F.col("in_reply_to_status_id"), F.lit(-1))
    links = F.expr("transform(entities.urls, u -> u.expanded_url)")
    tags = F.expr("transform(entities.hashtags, h -> h.text)")
    no_tags = F.array().cast("array<string>")
    return routed.select(
        _number("id").alias("id"),
        "ts",
        "topic",
        F.when(is_share, RETWEET).when(reply_to > 0, REPLY).otherwise(ORIGINAL).alias("tweet_type"),
        is_share.alias("retweet"),
        F.coalesce(text, F.lit("")).alias("text"),
        _string("lang").alias("lang"),
        _string("source").alias("source"),
        F.col("user.name").alias("account_name"),
        F.col("user.screen_name").alias("screen_name"),
        _number("user.id").alias("user_id"),
        _number("user.followers_count").alias("followers"),
        F.coalesce(F.col("user.verified"), F.lit(False)).alias("verified"),
        _string("user.profile_image_url").alias("img_url"),
        _string("user.description").alias("profile_text"),
        _string("user.location").alias("profile_location"),
        reply_to.alias("in_reply_to"),
        (F.coalesce(F.size("entities.urls"), F.lit(0)) > 0).alias("has_links"),
        F.coalesce(F.array_join(links, " "), F.lit("")).alias("links"),
        (F.coalesce(F.size("entities.hashtags"), F.lit(0)) > 0).alias("has_hashtags"),
        F.coalesce(tags, no_tags).alias("hashtags"),
        _number("favorite_count").cast("int").alias("favorite_count"),
        _number("retweet_count").cast("int").alias("retweet_count"),
        _number("retweeted_status.id").alias("retweet_id"),
        _string("retweeted_status.user.name").alias("retweet_account_name"),
        _string("retweeted_status.user.screen_name").alias("retweet_screen_name"),
        _number("retweeted_status.retweet_count").alias("retweet_num_retweets"),
        _number("retweeted_status.user.followers_count").alias("retweet_followers"),
        _string("retweeted_status.user.profile_image_url").alias("retweet_img_url"),
    )


def _string(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def select_posts(
    posts: DataFrame,
    langs: str = "",
    terms: str = "",
    users: str = "",
) -> DataFrame:
    """The source's own filter over comma lists, each of them optional.

    Languages narrow the result. Track phrases and user ids widen each other:
    a post stays when it has all words of any phrase, or is by a listed user.
    """
    kept = posts
    if wanted := _items(langs):
        kept = kept.filter(F.col("lang").isin(*wanted))
    found = None
    if phrases := _items(terms):
        searched = F.lower(F.concat_ws(" ", "text", "links", F.array_join("hashtags", " ")))
        if len(phrases) > MAX_INLINE:
            found = any_phrase(searched, [phrase.lower().split() for phrase in phrases])
        else:
            found = searched.rlike(_any_phrase(phrases))
    if ids := _items(users):
        listed = F.col("user_id").isin(*[int(user) for user in ids])
        found = listed if found is None else found | listed
    return kept if found is None else kept.filter(found)


def _any_phrase(phrases: list[str]) -> str:
    """One pattern for all phrases, so that a text is prepared and read once:
    some phrase has each of its words, in any order, as a whole word."""
    whole = r"(?=.*?(?<!\w){}(?!\w))"
    each = ("".join(whole.format(_quoted(word)) for word in phrase.lower().split()) for phrase in phrases)
    # (?U): letters and digits of all scripts make up words.
    return r"(?sU)\A(?:" + "|".join(each) + ")"


def _quoted(word: str) -> str:
    """The word as a pattern: what is no letter or digit goes by its code."""
    return "".join(char if char.isalnum() else f"\\x{{{ord(char):x}}}" for char in word)


def _items(comma_list: str) -> list[str]:
    return [item.strip() for item in comma_list.split(",") if item.strip()]
