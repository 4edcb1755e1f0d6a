import random
from fractions import Fraction

import pytest
from helpers import at, rows_of

from postpulse.operators import predict


def cut(x):
    return int(max(min(x, 2147483647), -2147483648))


def series(spark, rows, kind):
    return spark.createDataFrame(
        [(at(60 * i), 1000 * i, x, topic, 1) for topic, i, x in rows],
        f"window_start timestamp, timestamp bigint, {kind}, topic string, cnt int",
    )


def smoothed(rows, seeds):
    out, last = [], dict(seeds)
    for topic, i, x in sorted(rows):
        if topic in last:
            last[topic] = cut((last[topic] + x) / 2)
            out.append((topic + "#prediction", at(60 * i), last[topic]))
    return sorted(out)


def check(spark, rows, seeds, value, kind, operator, **kwargs):
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    base = spark.createDataFrame(list(seeds.items()), f"topic string, {value} int")
    found = operator(series(spark, shuffled, f"{value} {kind}"), base, **kwargs)
    assert rows_of(found, "topic", "window_start", value) == smoothed(rows, seeds)


def test_odd_sums_negative_values_and_unknown_topics(spark):
    rows = [("a", 0, 3), ("a", 1, -8), ("a", 5, -3), ("b", 0, 1)]
    check(spark, rows, {"a": 2, "c": 9}, "length", "int", predict.predict_avg_length)
    doubles = [(t, i, x + 0.5) for t, i, x in rows]
    check(spark, doubles, {"a": 2}, "retweets", "double", predict.predict_avg_retweets)


@pytest.mark.parametrize("case", ["random", "constant", "extreme", "small", "around zero"])
def test_pieces_link_exactly(spark, case):
    """Many pieces per topic, over gaps and several days."""
    rng = random.Random(case)
    draw = {
        "random": lambda: rng.randint(0, 5000),
        "constant": lambda: 5,
        "extreme": lambda: rng.choice([2147483647, -2147483648, 0]),
        "small": lambda: rng.randint(0, 2),
        "around zero": lambda: rng.choice([-1, 0, 1]),
    }[case]
    rows = []
    for topic in "abcd":
        places = sorted(rng.sample(range(6000), 300))
        rows += [(topic, i, draw()) for i in places]
    seeds = {"a": 0, "b": 4, "c": -7, "d": 2147483647}
    check(spark, rows, seeds, "length", "int", predict.predict_avg_length, piece=33)
    halves = [(t, i, x + rng.choice([0.0, 0.25, 1 / 3])) for t, i, x in rows]
    check(spark, halves, seeds, "retweets", "double", predict.predict_avg_retweets, piece=40)


def test_pieces_must_be_long_enough(spark):
    with pytest.raises(ValueError):
        check(spark, [("a", 0, 1)], {"a": 1}, "length", "int", predict.predict_avg_length, piece=32)


def fitted(rows):
    """Exact least squares over each topic's earlier points."""
    out = []
    for topic in {row[0] for row in rows}:
        points = sorted(row for row in rows if row[0] == topic)
        for at_, (_, i, f, r) in enumerate(points):
            past = [(Fraction(p[2]), Fraction(p[3])) for p in points[:at_]]
            n = len(past)
            predicted = 0
            if n >= 2:
                mx, my = sum(x for x, _ in past) / n, sum(y for _, y in past) / n
                sxx = sum((x - mx) ** 2 for x, _ in past)
                if sxx:
                    slope = sum((x - mx) * (y - my) for x, y in past) / sxx
                    predicted = cut(my + slope * (f - mx))
            out.append((topic + "#prediction", at(60 * i), f, predicted))
    return sorted(out)


def line_series(spark, rows):
    return spark.createDataFrame(
        [(at(60 * i), i, f, r, topic, 1) for topic, i, f, r in rows],
        "window_start timestamp, timestamp bigint, followers bigint, retweets int, topic string, cnt int",
    )


@pytest.mark.parametrize(
    "points",
    [
        [(5, 1)],
        [(5, 1), (6, 2)],
        [(1, 1), (3, 3), (10, 0)],
        [(4, 1), (4, 9), (4, 5), (4, 2)],
        [(1, 0), (2, 2147483647), (2147483647, 1), (-5, 3)],
        [(10, 100), (20, 50), (40, 7), (3, 3)],
    ],
)
def test_line(spark, points):
    rows = [("a", i, f, r) for i, (f, r) in enumerate(points)]
    found = predict.predict_retweets_followers(line_series(spark, rows))
    assert rows_of(found, "topic", "window_start", "followers", "retweets") == fitted(rows)


def test_line_over_many_days(spark):
    rng = random.Random(3)
    rows = [
        (topic, i, rng.randint(0, 10**9), rng.randint(0, 10**6))
        for topic in "ab"
        for i in sorted(rng.sample(range(9000), 200))
    ]
    found = rows_of(
        predict.predict_retweets_followers(line_series(spark, rows)),
        "topic", "window_start", "followers", "retweets",
    )
    assert found == fitted(rows)


def test_running_totals(spark):
    from pyspark.sql import functions as F

    rows = [("a", 0, 1), ("a", 1, 2), ("a", 2000, 4), ("a", 4000, 8), ("b", 3, 16)]
    totals = predict.running_totals(series(spark, rows, "x int"), {"_s": F.col("x"), "_n": F.lit(1)})
    assert rows_of(totals, "topic", "x", "_s", "_n") == [
        ("a", 1, 0, 0), ("a", 2, 1, 1), ("a", 4, 3, 2), ("a", 8, 7, 3), ("b", 16, 0, 0),
    ]
