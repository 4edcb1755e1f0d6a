import random

from helpers import rows_of
from pyspark.sql import functions as F

from postpulse.functions import phrases
from postpulse.functions.topics import TopicRules, topic_of
from postpulse.sources.raw import _any_phrase

ALPHABET = "abé. _-²ⅷ́‍😀"


def some(rng, n, size, letters=ALPHABET):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, size))) for _ in range(n)]


def test_many_rules_equal_one_by_one(spark):
    rng = random.Random(3)
    texts = some(rng, 300, 30) + ["", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for n in (1, 40, phrases.MAX_INLINE + 30):
        needles = some(rng, n, 4)
        labels = [f"l{i % 7}" for i in range(n)]
        rules = TopicRules(tuple(zip(needles, labels)), "none")
        found = rows.select("id", topic_of(F.col("t"), rules).alias("topic"))
        plain = [next((lab for x, lab in zip(needles, labels) if t is not None and x in t), "none") for t in texts]
        assert rows_of(found, "id", "topic") == list(enumerate(plain))
        place = rows.select("id", phrases.first_needle(F.col("t"), needles).alias("p"))
        by_hand = [next((i for i, x in enumerate(needles) if t is not None and x in t), None) for t in texts]
        assert [row.p for row in place.orderBy("id").collect()] == by_hand


def test_the_empty_needle_is_in_every_text(spark):
    rows = spark.createDataFrame([(0, "ab"), (1, ""), (2, None), (3, "x")], "id int, t string")
    found = rows.select("id", phrases.first_needle(F.col("t"), ["a", "", "x"]).alias("p")).orderBy("id")
    assert [row.p for row in found.collect()] == [0, 1, None, 1]


def test_many_phrases_equal_the_pattern(spark):
    """Marks, digits of other scripts, joiners and signs at the ends of words."""
    rng = random.Random(4)
    letters = ALPHABET.replace(" ", "")
    texts = some(rng, 400, 24) + [""]
    wanted = [" ".join(some(rng, rng.randint(1, 3), 2, letters)) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = rows.select(
        "id", F.col("t").rlike(_any_phrase(wanted)).alias("plain"),
        phrases.any_phrase(F.col("t"), [phrase.split() for phrase in wanted]).alias("many"),
    ).collect()
    assert [row.id for row in found if row.plain != row.many] == []
    assert 0 < sum(row.many for row in found) < len(found)


def test_one_pass_for_ten_thousand_needles(spark):
    needles = [f"needle{i:05d}" for i in range(10_000)]
    rules = TopicRules(tuple((needle, needle) for needle in needles), "none")
    rows = spark.createDataFrame([(1, "a needle00077 and needle00012"), (2, "needle 1")], "id int, t string")
    routed = rows.select("id", topic_of(F.col("t"), rules).alias("topic"))
    assert rows_of(routed, "id", "topic") == [(1, "needle00012"), (2, "none")]
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
