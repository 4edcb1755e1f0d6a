"""Word counts of a stream's windows, without a state row for each word.

A windowed aggregation holds the texts of the open windows, a row for each
distinct text; that is all the state. One watermark closes a window, so its
texts come out in one micro-batch, and their words are counted there and then:
combined by the tasks that give out the texts, dealt out by window, topic and
word, and combined once more. Where only listed words are asked for, the uses of
others are dropped as they leave their texts, before anything is combined.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import millis
from ..functions.text import STOP_WORDS, is_counted_word, tokens

# The combiners travel to the executors whole: no package to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS = ["window_start", "topic", "word"]
NAMES = [*KEYS, "first", "cnt"]
COUNTS = "window_start BIGINT, topic STRING, word STRING, first BIGINT, cnt BIGINT"
# Rows that are combined at a time, and those that a map task holds at most.
STEP = 1 << 19
# Tasks of the last step for each shuffle partition: a task holds its counts.
SPREAD = 4


def closed_word_count(
    posts: DataFrame, window: str, clock: str, among: DataFrame | None = None
) -> DataFrame:
    """(window_start, timestamp, word, topic, cnt) of a stream with a watermark
    on ``clock``: all word uses of each window, as it closes, or those of the
    words that ``among`` lists for their topic."""
    held = posts.groupBy(F.window(clock, window).alias("_window"), "topic", "text").agg(
        F.min("ts").alias("_first"), F.count(F.lit(1)).alias("cnt")
    )
    start, first = F.unix_micros("_window.start"), millis(F.col("_first"))
    words = tokens(F.col("text"))
    lead, rest = [start.alias("window_start"), "topic"], [first.alias("first"), "cnt"]
    if among is None:
        counted = held.select(*lead, words.alias("words"), *rest).mapInArrow(_count_texts, COUNTS)
    else:
        uses = held.select(*lead, F.explode(words).alias("word"), *rest)
        uses = listed(uses.filter(is_counted_word(F.col("word"))), among)
        counted = uses.mapInArrow(_combiner(STEP), COUNTS)
    tasks = SPREAD * int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.repartition(tasks, *KEYS)
    return dealt.mapInArrow(_combiner(None), COUNTS).select(
        F.timestamp_micros("window_start").alias("window_start"),
        F.col("first").alias("timestamp"),
        "word",
        "topic",
        "cnt",
    )


def listed(uses: DataFrame, among: DataFrame) -> DataFrame:
    """Uses of the words that ``among`` lists for their topic. Nulls are equal:
    plain equality filters null topics, which Spark would move below the
    watermark, so that their posts would no longer close windows."""
    keys = among.select(F.col("word").alias("_word"), F.col("topic").alias("_topic"))
    same = F.col("word").eqNullSafe(F.col("_word")) & F.col("topic").eqNullSafe(F.col("_topic"))
    return uses.join(keys, same, "left_semi")


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _combiner(STEP)(_uses(batches))


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each use of a counted word, of texts as lists of words. No more
    than about ``STEP`` uses, or one text's, at a time."""
    ignored = pa.array(sorted(set(STOP_WORDS)))
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("words")), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype="int64")
        cuts = [0, *(np.flatnonzero(np.diff(ends // STEP)) + 1).tolist(), batch.num_rows]
        for start, end in itertools.pairwise(cuts):
            part = batch.slice(start, end - start)
            lists = part.column("words")
            words, texts = pc.list_flatten(lists), pc.list_parent_indices(lists)
            counted = pc.invert(pc.is_in(words, value_set=ignored.cast(words.type)))
            words, texts = words.filter(counted), texts.filter(counted)
            columns = [words if name == "word" else part.column(name).take(texts) for name in NAMES]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def _combiner(most: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds up a partition's rows of equal keys. With ``most`` a key may come
    several times: what is held is given out when it is more rows than that."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, room = 0, STEP
        for batch in batches:
            # By names alone: Spark marks what is never null, a sum isn't marked.
            held.append(pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names))
            rows += batch.num_rows
            if rows >= room:
                held = _combined(held)
                rows = sum(part.num_rows for part in held)
                if most is not None and 2 * rows > most:
                    yield from held
                    held, rows = [], 0
                room = max(STEP, 2 * rows)
        if held:
            yield from _combined(held)

    return combine


def _combined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    grouped = pa.Table.from_batches(batches).group_by(KEYS, use_threads=False)
    found = grouped.aggregate([("first", "min"), ("cnt", "sum")])
    ordered = found.select([*KEYS, "first_min", "cnt_sum"]).rename_columns(NAMES)
    return ordered.to_batches(max_chunksize=1 << 16)
