"""Lexicon sentiment of a post: the sign of the summed word weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text, tokens
from ..schema import ARRIVAL
from ..session import stage

# The labels.
POSITIVE, NEGATIVE, NEUTRAL, ERROR = "POSITIVE", "NEGATIVE", "NEUTRAL", "ERROR"

# A lexicon is written into the plan up to this many words; larger ones are
# read as a table.
MAX_INLINE_WORDS = 10_000


def read_lexicon(spark: SparkSession, path: str, as_table: bool = False) -> dict[str, int] | DataFrame:
    """A ``word;weight`` file, as a dict to inline or, on demand or if it has too
    many words for that, as a table to join. Of a word's weights the largest
    counts. Both give the same labels, on streams too."""
    rows = spark.read.schema("word STRING, weight INT").option("sep", ";").csv(path)
    lexicon = one_weight(rows)
    if as_table:
        return lexicon
    found = {row.word: row.weight for row in lexicon.take(MAX_INLINE_WORDS + 1)}
    return found if len(found) <= MAX_INLINE_WORDS else lexicon


def one_weight(lexicon: DataFrame) -> DataFrame:
    rows = lexicon.filter(F.col("word").isNotNull() & F.col("weight").isNotNull())
    return rows.groupBy("word").agg(F.max("weight").alias("weight"))


def label_of(score: Column) -> Column:
    """Label by sign; a post without a score had nothing left after cleaning."""
    return (
        F.when(score.isNull(), ERROR)
        .when(score > 0, POSITIVE)
        .when(score < 0, NEGATIVE)
        .otherwise(NEUTRAL)
    )


def lexicon_score(text: Column, lexicon: dict[str, int]) -> Column:
    """Summed weights of a text's words, within the row: nothing is shuffled.

    One hash-set test per word finds the few words the lexicon knows; only
    those are tested again, along a tree of the distinct weights.
    """
    if len(lexicon) > MAX_INLINE_WORDS:
        raise ValueError("lexicon too large to inline, use sentiment_by_join")
    if not lexicon:
        return F.lit(0)
    by_weight: dict[int, list[str]] = {}
    for word, weight in lexicon.items():
        by_weight.setdefault(weight, []).append(word)
    known = F.filter(tokens(text), lambda word: word.isin(*lexicon))

    def weight_of(word: Column, groups: list[tuple[int, list[str]]]) -> Column:
        """Halves the weights at each level, so that many don't nest deeply."""
        if len(groups) == 1:
            return F.lit(groups[0][0])
        half = len(groups) // 2
        first = [w for _, words in groups[:half] for w in words]
        return F.when(word.isin(*first), weight_of(word, groups[:half])).otherwise(
            weight_of(word, groups[half:])
        )

    return F.aggregate(
        known, F.lit(0), lambda total, word: total + weight_of(word, list(by_weight.items()))
    )


def with_sentiment(posts: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """Adds the label. Cleaned text and score are projections of their own:
    both are used more than once and would otherwise be computed as often."""
    score = F.when(F.trim("_cleaned") != "", lexicon_score(F.col("_cleaned"), lexicon))
    return (
        posts.withColumn("_cleaned", clean_text(F.col("text")))
        .withColumn("_score", score)
        .withColumn("sentiment", label_of(F.col("_score")))
        .drop("_cleaned", "_score")
    )


def sentiment_by_join(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Labels from a lexicon table of any size: (word, weight).

    Every row is a post of its own, as when the lexicon is inlined. A post's
    words are counted within the row first, so a word travels once per post;
    where the lexicon doesn't broadcast, adaptive skew handling splits the
    frequent words.
    """
    if posts.isStreaming:
        raise ValueError("a stream needs a window: see stream_sentiment_by_join")
    kept = [name for name in ("id", "ts", ARRIVAL) if name in posts.columns]
    # Stored, so that the numbers of the rows stay what they are.
    cleaned = stage(
        posts.select(*kept, "topic", clean_text(F.col("text")).alias("_cleaned")).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "sentiment",
    )
    words = cleaned.select("_row", F.explode(tokens(F.col("_cleaned"))).alias("word"))
    counted = words.groupBy("_row", "word").agg(F.count("*").alias("_n"))
    scores = (
        counted.join(one_weight(lexicon), "word")
        .groupBy("_row")
        .agg(F.sum(F.col("weight") * F.col("_n")).alias("_sum"))
    )
    score = F.when(F.trim("_cleaned") != "", F.coalesce("_sum", F.lit(0)))
    labelled = cleaned.join(scores, "_row", "left").withColumn("_score", score)
    return labelled.select(*kept, "topic", label_of(F.col("_score")).alias("sentiment"))


def stream_sentiment_by_join(posts: DataFrame, lexicon: DataFrame, window: str) -> DataFrame:
    """Labelled posts of a stream with a watermark, by a lexicon table of any
    size: (window, topic, sentiment, first, posts), several rows of a group.

    Words meet the stored lexicon in a join of the stream with a table; a post's
    words come together again in a first windowed aggregation, whose state holds
    a score for each post of the open windows, and no text. Posts that are alike
    in id, time and text are one row of several posts. A second aggregation may
    follow, as ``sentiment_count`` does."""
    times = [name for name in ("ts", ARRIVAL) if name in posts.columns]
    ids = [name for name in ("id",) if name in posts.columns]
    cleaned = posts.select(*times, *ids, "topic", clean_text(F.col("text")).alias("_cleaned"))
    # Beside its words every post has a row of no word, which counts it.
    nothing = F.array(F.lit(None).cast("string"))
    words = cleaned.select(
        *times, *ids, "topic",
        F.unix_micros("ts").alias("_at"),
        F.xxhash64("_cleaned").alias("_text"),
        (F.trim("_cleaned") != "").alias("_said"),
        F.explode(F.concat(nothing, tokens(F.col("_cleaned")))).alias("word"),
    )
    known = stage(one_weight(lexicon), "lexicon")
    scored = (
        words.join(known, "word", "left")
        .groupBy(F.window(times[-1], window).alias("_window"), *ids, "topic", "_at", "_text", "_said")
        .agg(F.sum("weight").alias("_sum"), F.count_if(F.col("word").isNull()).alias("posts"))
    )
    score = F.when(F.col("_said"), F.coalesce("_sum", F.lit(0)))
    return scored.select(
        F.window_time("_window").alias("_clock"), "topic", label_of(score).alias("sentiment"),
        F.timestamp_micros("_at").alias("first"), "posts",
    )
