"""Streaming predictions: small per-topic state over closed windows.

Windows of one micro-batch may arrive in any order and are sorted first;
windows of later batches are later, because one watermark closes them all.
The state is one number, or five exact sums, per topic.
"""

from __future__ import annotations

import heapq
import itertools
import sys
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.numeric import INT_MAX, INT_MIN
from ..operators.metrics import USER_COLUMNS, first_of_windows, topic_summary, user_records
from ..operators.predict import SUFFIX, line_at
from ..operators.topn import WINDOWED
from .windows import END_OF_TIME

# Number of windows, their followers, re-shares, squares and products.
SUMS = ("n", "f", "r", "ff", "fr")

# The processors travel to the executors whole: no package to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _cut(value: float) -> int:
    """Fraction cut off, clamped to INT, NaN 0."""
    if value != value:
        return 0
    return int(max(min(value, float(INT_MAX)), float(INT_MIN)))


def _ordered(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(batches), ignore_index=True).sort_values("window_start")


class Smoothing(StatefulProcessor):
    """Cut-off mean of the last prediction and the window's value. The first
    prediction is the topic's stored mean, which the state is loaded with; a
    topic without one gives no rows."""

    def __init__(self, value: str) -> None:
        self.value = value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(
            "last", T.StructType([T.StructField("prediction", T.IntegerType())])
        )

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.last.update((int(initialState["seed"].iloc[0]),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.last.exists():
            return
        frame = _ordered(rows)
        last = self.last.get()[0]
        predicted = []
        for current in frame[self.value]:
            last = _cut((last + current) / 2)
            predicted.append(last)
        self.last.update((last,))
        yield pd.DataFrame(
            {
                "window_start": frame["window_start"],
                "timestamp": frame["timestamp"],
                self.value: predicted,
                "topic": key[0] + SUFFIX,
                "cnt": 1,
            }
        )

    def close(self) -> None:
        pass


class Stored(StatefulProcessor):
    """Adds its key's stored value to each row. The state is loaded with the
    stored values once, and never changes; a key without one gives no rows."""

    def __init__(self, kind: T.DataType) -> None:
        self.kind = kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", T.StructType([T.StructField("value", self.kind)]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.value.update((initialState["_stored"].tolist()[0],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.value.exists():
            return
        value = self.value.get()[0]
        for frame in rows:
            yield frame.assign(_stored=value)

    def close(self) -> None:
        pass


class Rollup(StatefulProcessor):
    """Rows of a key's narrow windows, and their sums by wider windows.

    Times are numbers (microseconds; window starts milliseconds). A narrow
    window's row comes once, when it closes, and goes on at once; a wider window
    is one row of state until the watermark passes its end."""

    def __init__(self, widths: list[int], firsts: list[str], sums: list[str]) -> None:
        self.narrow, *self.wider = widths
        self.merge = {name: "min" for name in firsts} | {name: "sum" for name in sums}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", _longs("width", "start"), _longs(*self.merge))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            yield self._rows(key, self.narrow, frame)
            for width in self.wider:
                parts = frame.groupby(frame["start"] // width * width)[list(self.merge)].agg(self.merge)
                for part in parts.itertuples(name=None):
                    start, *found = map(int, part)
                    at = (width, start)
                    if self.open.containsKey(at):
                        both = zip(self.merge.values(), self.open.getValue(at), found)
                        found = [min(a, b) if how == "min" else a + b for how, a, b in both]
                    else:
                        self.handle.registerTimer(start + width)
                    self.open.updateValue(at, tuple(found))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        for width in self.wider:
            at = (width, end - width)
            if self.open.containsKey(at):
                frame = pd.DataFrame([tuple(self.open.getValue(at))], columns=list(self.merge))
                self.open.removeKey(at)
                yield self._rows(key, width, frame.assign(start=end - width))

    def _rows(self, key, width: int, frame: pd.DataFrame) -> pd.DataFrame:
        found = frame[["start", *self.merge]]
        return found.assign(width=width, topic=key[0], tweet_type=key[1])

    def close(self) -> None:
        pass


def _longs(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType()) for name in names])


class LineFit(StatefulProcessor):
    """Sums over a topic's earlier windows; the line follows from them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        total = T.DecimalType(38, 0)
        self.sums = handle.getValueState(
            "sums", T.StructType([T.StructField(name, total) for name in SUMS])
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _ordered(rows)
        sums = tuple(int(total) for total in self.sums.get()) if self.sums.exists() else (0,) * 5
        before = []
        for at, retweets in zip(frame["followers"].tolist(), frame["retweets"].tolist()):
            before.append(tuple(map(Decimal, sums)))
            own = (1, at, retweets, at * at, at * retweets)
            sums = tuple(total + more for total, more in zip(sums, own))
        self.sums.update(tuple(map(Decimal, sums)))
        columns = dict(zip(SUMS, zip(*before)))
        yield pd.DataFrame(
            {
                "window_start": frame["window_start"],
                "timestamp": frame["timestamp"],
                "followers": frame["followers"],
                "topic": key[0] + SUFFIX,
                **{name: list(values) for name, values in columns.items()},
            }
        )

    def close(self) -> None:
        pass


class FirstRecord(StatefulProcessor):
    """The record a handle had when it was first seen.

    Gives, for each window of a micro-batch, the handle's earliest post with
    that record: no other post of the handle can be the window's first one. A
    handle without a post for ``keep_ms`` of event time is forgotten; the state
    is one record for each handle of that time, and not of all time."""

    def __init__(self, keep_ms: int, window_ms: int, times: list[str]) -> None:
        self.keep_ms, self.window_ms, self.times = keep_ms, window_ms, times

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        text = T.StringType()
        record = {"timestamp": T.LongType(), "account_name": text, "followers": T.LongType(), "img_url": text}
        fields = [T.StructField(name, kind) for name, kind in record.items()]
        # until: when the handle is forgotten, and the timer that does it.
        self.first = handle.getValueState("first", T.StructType([*fields, T.StructField("until", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True).sort_values(["ms", "id"], kind="stable")
        known = tuple(self.first.get()) if self.first.exists() else None
        if known is None:
            own = frame.iloc[0]
            record = (int(own["timestamp"]), _text(own["account_name"]), _whole(own["followers"]), _text(own["img_url"]))
        else:
            record = known[:-1]
            self.handle.deleteTimer(known[-1])
        until = int(max(frame["clock"].max(), timerValues.getCurrentWatermarkInMs())) + self.keep_ms
        if known is not None:
            until = max(until, known[-1])
        self.first.update((*record, until))
        self.handle.registerTimer(until)
        frame = frame[~(frame["clock"] // self.window_ms).duplicated()]
        n = len(frame)
        yield pd.DataFrame(
            {
                **{name: frame[name] for name in self.times},
                "id": frame["id"],
                "timestamp": [record[0]] * n,
                "account_name": [record[1]] * n,
                "screen_name": [key[0]] * n,
                "followers": pd.array([record[2]] * n, dtype="Int64"),
                "img_url": [record[3]] * n,
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.first.clear()
        return iter([])

    def close(self) -> None:
        pass


def _text(value) -> str | None:
    return value if isinstance(value, str) else None


def _whole(value) -> int | None:
    return None if pd.isna(value) else int(value)


class Largest(StatefulProcessor):
    """The largest rows of each window and topic. A window's counts all come in
    the micro-batch that closes it, so nothing is kept for the next one; of its
    rows no more than n are held at a time."""

    def __init__(self, item: str, n: int) -> None:
        self.item, self.n = item, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best: list[tuple] = []
        for frame in rows:
            found = zip((-frame["cnt"]).tolist(), frame[self.item].tolist(), frame["timestamp"].tolist())
            best = heapq.nsmallest(self.n, itertools.chain(best, found))
        yield pd.DataFrame(
            {
                "window_start": [key[0]] * len(best),
                "timestamp": [timestamp for _, _, timestamp in best],
                self.item: [item for _, item, _ in best],
                "topic": [key[1]] * len(best),
                "cnt": [-negative for negative, _, _ in best],
            }
        )

    def close(self) -> None:
        pass


def _cut_tasks(item: str, n: int):
    """Cuts each Arrow batch of counts to the largest rows of a window and
    topic, in the order of ``Largest``: no other row can be among them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.select(["window_start", "topic", item, "cnt"]).to_pandas()
            ordered = frame.sort_values(["cnt", item], ascending=[False, True])
            kept = ordered.groupby(["window_start", "topic"], sort=False, dropna=False).head(n)
            yield batch.take(pa.array(kept.index.to_numpy()))

    return cut


def stream_top_of_windows(posts: DataFrame, item: str, window: str, n: int | None = None) -> DataFrame:
    """``top_of_windows`` of a stream with a watermark: windowed counts, then
    their largest, as the windows close. One task ranks a window's topic; it
    takes up to n rows from each Arrow batch of counts."""
    count, usual = WINDOWED[item]
    n = usual if n is None else n
    counts = count(posts, window, more_than=0).withColumn("window_start", F.unix_micros("window_start"))
    candidates = counts.mapInArrow(_cut_tasks(item, n), counts.schema).withColumn(
        "window_start", F.timestamp_micros("window_start")
    )
    return candidates.groupBy("window_start", "topic").transformWithStateInPandas(
        Largest(item, n),
        f"window_start TIMESTAMP, timestamp BIGINT, {item} STRING, topic STRING, cnt BIGINT",
        outputMode="append",
        timeMode="none",
    )


def stream_popular_user(posts: DataFrame, window: str, keep: str = "30 days") -> DataFrame:
    """``popular_user_running`` of a stream with a watermark.

    The first record is that of the first micro-batch with the handle, and in
    it of the earliest post; ``keep`` is how long a handle is remembered after
    its last post. A chain of two stateful steps: records by handle, then their
    windows, which the same watermark closes."""
    keep_ms, window_ms = _milliseconds(keep), _milliseconds(window)
    records = user_records(posts)
    times = [name for name in records.columns if name not in ("id", "user")]
    clock = times[-1]
    # The closing row moves the watermark, and is beyond what pandas can tell.
    users = records.filter(F.col(clock) < F.lit(END_OF_TIME)).select(
        *times, "id", F.unix_millis("ts").alias("ms"), F.unix_millis(clock).alias("clock"), "user.*"
    )
    first = users.groupBy("screen_name").transformWithStateInPandas(
        FirstRecord(keep_ms, window_ms, times),
        ", ".join(f"{name} TIMESTAMP" for name in times)
        + ", id BIGINT, timestamp BIGINT, account_name STRING, screen_name STRING, followers BIGINT, img_url STRING",
        outputMode="append",
        timeMode="eventTime",
        eventTimeColumnName=clock,
    )
    return first_of_windows(first.select(*times, "id", F.struct(*USER_COLUMNS).alias("user")), window)


def _milliseconds(interval: str) -> int:
    """Of an interval of days or less ("60 seconds", "30 days")."""
    number, unit = interval.split()
    return int(number) * _UNITS[unit.lower().rstrip("s")]


_UNITS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


# Later than any time in microseconds: stands for no time.
_NEVER = (1 << 63) - 1


def stream_summaries(posts: DataFrame, widths: list[str]) -> DataFrame:
    """``topic_summary`` of a stream with a watermark for several window widths
    at once, with the width as given in a column ``width``.

    Posts are counted once, in windows of the first width; the others are
    multiples of it, and are summed from its closed windows, a row for each
    topic, type and open window. ``of_width`` gives one width's summary, from
    which all metrics of it follow. Sums of nothing are 0."""
    spans = [_milliseconds(width) for width in widths]
    if any(span % spans[0] for span in spans):
        raise ValueError(f"all widths must be multiples of the first: {widths}")
    summary = topic_summary(posts, widths[0])
    firsts = [name for name in ("first_ts", "first_text_ts") if name in summary.columns]
    keys = ["window_start", "window_end", "topic", "tweet_type"]
    sums = [name for name in summary.columns if name not in [*keys, *firsts]]
    numbers = summary.select(
        "topic", "tweet_type", F.unix_millis("window_start").alias("start"),
        *[F.coalesce(F.unix_micros(name), F.lit(_NEVER)).alias(name) for name in firsts],
        *[F.coalesce(F.col(name).cast("long"), F.lit(0)).alias(name) for name in sums],
    )
    rolled = numbers.groupBy("topic", "tweet_type").transformWithStateInPandas(
        Rollup(spans, firsts, sums),
        ", ".join(f"{name} BIGINT" for name in ["start", *firsts, *sums, "width"])
        + ", topic STRING, tweet_type STRING",
        outputMode="append",
        timeMode="eventTime",
    )
    named = F.create_map(*[item for span, width in zip(spans, widths) for item in (F.lit(span).cast("long"), F.lit(width))])
    return rolled.select(
        named[F.col("width")].alias("width"),
        F.timestamp_millis("start").alias("window_start"),
        F.timestamp_millis(F.col("start") + F.col("width")).alias("window_end"),
        "topic", "tweet_type",
        *[F.when(F.col(name) < _NEVER, F.timestamp_micros(name)).alias(name) for name in firsts],
        *sums,
    )


def of_width(summaries: DataFrame, width: str) -> DataFrame:
    """The rows of one width of ``stream_summaries``, as ``topic_summary`` gives them."""
    return summaries.filter(F.col("width") == width).drop("width")


def stream_smoothed(series: DataFrame, seeds: DataFrame, value: str) -> DataFrame:
    """Predictions for a windowed mean; ``seeds`` is the stored (topic, mean),
    read once, when the query first starts."""
    loaded = seeds.select("topic", F.col(value).cast("int").alias("seed")).dropna()
    return series.groupBy("topic").transformWithStateInPandas(
        Smoothing(value),
        f"window_start TIMESTAMP, timestamp BIGINT, {value} INT, topic STRING, cnt INT",
        outputMode="append",
        timeMode="none",
        initialState=loaded.groupBy("topic"),
    )


def stream_difference(live: DataFrame, baseline: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``compare.difference`` of a stream. The baseline, a row per key, is read
    once, when the query first starts, and is keyed state from then on; a join
    would read it again for every micro-batch."""
    stored = baseline.select(*keys, F.col(value).alias("_stored")).dropna()
    kind = stored.schema["_stored"].dataType
    met = live.groupBy(*keys).transformWithStateInPandas(
        Stored(kind),
        T.StructType([*live.schema, T.StructField("_stored", kind)]),
        outputMode="append",
        timeMode="none",
        initialState=stored.groupBy(*keys),
    )
    return met.withColumn(value, F.col(value) - F.col("_stored")).select(*live.columns)


def stream_line(series: DataFrame) -> DataFrame:
    """Predicted re-shares for each window's audience."""
    summed = series.groupBy("topic").transformWithStateInPandas(
        LineFit(),
        "window_start TIMESTAMP, timestamp BIGINT, followers BIGINT, topic STRING, "
        + ", ".join(f"{name} DECIMAL(38,0)" for name in SUMS),
        outputMode="append",
        timeMode="none",
    )
    predicted = line_at(*map(F.col, SUMS), F.col("followers"))
    return summed.select(
        "window_start", "timestamp", "followers", predicted.alias("retweets"), "topic",
        F.lit(1).alias("cnt"),
    )
