"""Topic router: the first matching needle, in rule order, names the topic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .phrases import MAX_INLINE, first_needle


@dataclass(frozen=True)
class TopicRules:
    needles: tuple[tuple[str, str], ...]
    default: str

    @property
    def topics(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([label for _, label in self.needles] + [self.default]))


# Needles in priority order with the topic each one stands for.
ELECTION_TOPICS = TopicRules(
    needles=(
        ("donald", "trump"),
        ("trump", "trump"),
        ("joe", "biden"),
        ("biden", "biden"),
        ("bernie", "sanders"),
        ("sanders", "sanders"),
        ("elizabeth", "warren"),
        ("warren", "warren"),
        ("election2020", "election2020"),
    ),
    default="election2020",
)


def topic_of(haystack: Column, rules: TopicRules) -> Column:
    """Topic of an already lower-cased text. Needles match inside words too.
    Many rules are looked for by one automaton, with the same result."""
    if len(rules.needles) > MAX_INLINE:
        return _topic_of_many(haystack, rules)
    routed = None
    for needle, label in rules.needles:
        hit = haystack.contains(needle)
        routed = F.when(hit, label) if routed is None else routed.when(hit, label)
    return F.lit(rules.default) if routed is None else routed.otherwise(rules.default)


def _topic_of_many(haystack: Column, rules: TopicRules) -> Column:
    place = first_needle(haystack, [needle for needle, _ in rules.needles])
    labels = F.lit([label for _, label in rules.needles])
    return F.coalesce(F.get(labels, place), F.lit(rules.default))


def route_topics(
    df: DataFrame,
    rules: TopicRules,
    text: Column,
    quoted: Column | None = None,
    into: str = "topic",
) -> DataFrame:
    """Adds the topic column.

    Text and quoted text are joined without a separator, so a needle may span
    the seam. The joined text is its own projection: every rule looks at it,
    and Spark does not copy a costly expression into several users.
    """
    haystack = F.lower(F.coalesce(text, F.lit("")))
    if quoted is not None:
        haystack = F.concat(haystack, F.lower(F.coalesce(quoted, F.lit(""))))
    return (
        df.withColumn("_haystack", haystack)
        .withColumn(into, topic_of(F.col("_haystack"), rules))
        .drop("_haystack")
    )
