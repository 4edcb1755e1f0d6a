"""Next-window predictions over windowed metrics.

Input rows are one per topic and window, so their number depends on the time
covered and not on the posts. The recurrences are sequential along a topic's
timeline; both are evaluated in pieces, so that no task holds a whole timeline.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import INT_MAX, INT_MIN, saturating_int
from ..session import stage

# Fixed value: marks predicted rows.
SUFFIX = "#prediction"

# Windows per piece. At least 33: see ``_smoothed``.
PIECE = 64


def halfway_double(previous: Column, current: Column) -> Column:
    """Cut-off mean of the last prediction and a DOUBLE value."""
    return saturating_int((previous.cast("double") + current) / 2)


def halfway_int(previous: Column, current: Column) -> Column:
    """Cut-off mean of the last prediction and an INT value."""
    total = previous.cast("bigint") + current.cast("bigint")
    return F.call_function("div", total, F.lit(2)).cast("int")


def predict_avg_retweets(series: DataFrame, seeds: DataFrame, piece: int = PIECE) -> DataFrame:
    return _smoothed(series, seeds, "retweets", halfway_double, piece)


def predict_avg_length(series: DataFrame, seeds: DataFrame, piece: int = PIECE) -> DataFrame:
    return _smoothed(series, seeds, "length", halfway_int, piece)


def predict_retweets_followers(series: DataFrame) -> DataFrame:
    """Re-shares expected for a window's audience, by a least-squares line
    through the topic's earlier windows; 0 while there is no line.

    The line needs only running sums. They are kept as exact decimals.
    """
    f = F.col("followers").cast("decimal(10,0)")
    r = F.col("retweets").cast("decimal(10,0)")
    summed = running_totals(
        stage(series, "series"), {"_n": F.lit(1), "_f": f, "_r": r, "_ff": f * f, "_fr": f * r}
    )
    predicted = line_at(
        *[F.col(name).cast("decimal(38,0)") for name in ("_n", "_f", "_r", "_ff", "_fr")],
        F.col("followers"),
    )
    return summed.select(
        "window_start", "timestamp", "followers", predicted.alias("retweets"),
        F.concat("topic", F.lit(SUFFIX)).alias("topic"), F.lit(1).alias("cnt"),
    )


def line_at(n: Column, f: Column, r: Column, ff: Column, fr: Column, at: Column) -> Column:
    """Least-squares line from its sums, evaluated and cut to INT. Rounding to
    six digits first keeps 4.9999999999 from becoming 4."""
    spread = (n * ff - f * f).cast("double")
    slope = (n * fr - f * r).cast("double") / spread
    count = n.cast("double")
    value = (r.cast("double") + slope * (count * at - f.cast("double"))) / count
    return F.when((n >= 2) & (spread != 0), saturating_int(F.round(value, 6))).otherwise(0)


def running_totals(series: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Adds, per topic, the sums over all strictly earlier windows.

    Days are summed on their own and only the day totals are carried along a
    topic, so the longest ordered run is one day of windows, or one row a day.
    """
    dated = series.withColumn("_day", F.date_trunc("day", "window_start"))
    days = dated.groupBy("topic", "_day").agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    before_day = _strictly_before(["topic"], "_day")
    carried = days.select(
        "topic",
        "_day",
        *[F.coalesce(F.sum(name).over(before_day), F.lit(0)).alias(f"{name}_days") for name in sums],
    )
    before = _strictly_before(["topic", "_day"], "window_start")
    within = dated.select(
        "*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(n) for n, v in sums.items()]
    )
    return within.join(carried, ["topic", "_day"]).select(
        *series.columns, *[(F.col(name) + F.col(f"{name}_days")).alias(name) for name in sums]
    )


def _strictly_before(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _smoothed(
    series: DataFrame,
    seeds: DataFrame,
    value: str,
    step: Callable[[Column, Column], Column],
    piece: int,
) -> DataFrame:
    """p(i) = step(p(i-1), x(i)) along each topic, from the topic's seed.

    ``step`` halves the distance between two start values, rounded up. After 33
    steps all 2^32 start values have therefore met in at most two neighbouring
    results: a piece of the timeline is described by its ``low`` and ``high``
    result and the ``turn``, the first start value that leads to ``high``.
    Pieces are described in parallel, linked by one bit each, and replayed in
    parallel from the start values found.

    ``seeds`` holds (topic, value); topics without one are left out.
    """
    if piece < 33:
        raise ValueError("a piece needs at least 33 windows")
    seeded = series.join(seeds.select("topic", F.col(value).cast("int").alias("_seed")), "topic")
    ranked = running_totals(stage(seeded, "series"), {"_rank": F.lit(1)})
    pieces = (
        ranked.withColumn("_piece", F.floor(F.col("_rank") / piece))
        .groupBy("topic", "_piece")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("window_start", "timestamp", F.col(value).alias("x")))
            ).alias("_rows"),
            F.min("_seed").alias("_seed"),
        )
    )

    def run(start: Column) -> Column:
        return F.aggregate("_rows", start.cast("int"), lambda p, row: step(p, row["x"]))

    described = pieces.select(
        "topic",
        "_piece",
        "_rows",
        "_seed",
        run(F.lit(INT_MIN)).alias("low"),
        run(F.lit(INT_MAX)).alias("high"),
    )
    starts = _link(described.withColumn("turn", _turn(step)))
    replay = F.aggregate(
        "_rows",
        F.struct(
            F.col("_start").alias("p"),
            F.array()
            .cast("array<struct<window_start: timestamp, timestamp: bigint, p: int>>")
            .alias("done"),
        ),
        lambda acc, row: _advance(acc, row, step(acc["p"], row["x"])),
        lambda acc: acc["done"],
    )
    replayed = pieces.join(starts, ["topic", "_piece"]).select("topic", F.inline(replay))
    return replayed.select(
        "window_start", "timestamp", F.col("p").alias(value),
        F.concat("topic", F.lit(SUFFIX)).alias("topic"), F.lit(1).alias("cnt"),
    )


def _advance(acc: Column, row: Column, predicted: Column) -> Column:
    done = F.struct(
        row["window_start"].alias("window_start"),
        row["timestamp"].alias("timestamp"),
        predicted.alias("p"),
    )
    return F.struct(predicted.alias("p"), F.concat(acc["done"], F.array(done)).alias("done"))


def _turn(step: Callable[[Column, Column], Column]) -> Column:
    """First start value whose result is ``high``, by one fold from the end:
    the least value before a step that reaches ``t`` after it is near 2t - x,
    and the step itself decides between that and its neighbours."""

    def back(t: Column, row: Column) -> Column:
        twice, x = 2 * t.cast("double"), row["x"].cast("double")
        near = F.when(t > 0, F.ceil(twice - x)).otherwise(F.floor(twice - 2 - x) + 1)
        guess = F.least(F.greatest(near, F.lit(INT_MIN)), F.lit(INT_MAX)).cast("bigint")
        below = F.greatest(guess - 1, F.lit(INT_MIN).cast("bigint"))
        above = F.least(guess + 1, F.lit(INT_MAX).cast("bigint"))
        return (
            F.when(step(below, row["x"]) >= t, below)
            .when(step(guess, row["x"]) >= t, guess)
            .otherwise(above)
        )

    first = F.aggregate(F.reverse("_rows"), F.col("high").cast("bigint"), back)
    return F.when(F.col("low") == F.col("high"), F.lit(INT_MIN).cast("bigint")).otherwise(first)


def _link(described: DataFrame) -> DataFrame:
    """Start value of every piece, from one slim row per piece.

    A piece starts at its predecessor's ``low`` or ``high``. Where both lie on
    the same side of its turn the outcome is known without the predecessor's;
    otherwise it is the predecessor's, so the last known outcome holds.
    """
    along = Window.partitionBy("topic").orderBy("_piece")
    slim = described.select("topic", "_piece", "_seed", "low", "high", "turn").select(
        "*",
        F.coalesce(F.lag("low").over(along), F.col("_seed")).alias("from_low"),
        F.coalesce(F.lag("high").over(along), F.col("_seed")).alias("from_high"),
    )
    up_if_low = F.col("from_low") >= F.col("turn")
    up_if_high = F.col("from_high") >= F.col("turn")
    known = slim.withColumn("_known", F.when(up_if_low == up_if_high, up_if_low))
    decided = known.withColumn("_up", F.last("_known", ignorenulls=True).over(along))
    came_up = F.lag("_up").over(along)
    return decided.select(
        "topic",
        "_piece",
        F.when(came_up, F.col("from_high")).otherwise(F.col("from_low")).alias("_start"),
    )
