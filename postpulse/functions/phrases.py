"""Many needles at once: one automaton reads a text once, whatever their number.

For more than ``MAX_INLINE`` needles, in place of an expression for each of
them. The needles are settings, held by the driver and sent with the plan; a
task builds their automaton once. Results are those of the expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Needles that are looked for by an expression each.
MAX_INLINE = 64

# What Spark's patterns take for a part of a word with (?U).
_WORD_CHAR = r"[\p{Alphabetic}\p{M}\p{Nd}\p{Pc}\p{Join_Control}]"

# The functions travel to the executors whole: no package to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _automaton(words: dict[str, int]) -> ahocorasick.Automaton:
    """Finds all places of all words; each place gives (last character, value)."""
    made = ahocorasick.Automaton()
    for word, value in words.items():
        made.add_word(word, (len(word), value))
    made.make_automaton()
    return made


def first_needle(haystack: Column, needles: list[str]) -> Column:
    """Place in the list of the first needle that a text holds, inside words
    too; null if there is none. A null text holds none, and every other text
    holds the empty needle."""
    ranks: dict[str, int] = {}
    for rank, needle in enumerate(needles):
        ranks.setdefault(needle, rank)
    always = ranks.pop("", None)
    ranks = {needle: rank for needle, rank in ranks.items() if always is None or rank < always}

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(ranks) if ranks else None
        for batch in texts:
            found = []
            for text in batch:
                best = None if text is None else always
                for _, (_, rank) in automaton.iter(text) if automaton and text else ():
                    if best is None or rank < best:
                        best = rank
                        if best == 0:
                            break
                found.append(best)
            yield pd.Series(found, dtype="Int32")

    # Annotations are text in this module, so the kind is given in full.
    find.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(find, "int")(haystack)


def any_phrase(haystack: Column, phrases: list[list[str]]) -> Column:
    """Does a text have all words of any phrase, in any order, as whole words?
    Words may hold characters that are no letters. A null text has none."""
    values = {word: value for value, word in enumerate(dict.fromkeys(w for phrase in phrases for w in phrase))}
    # A phrase is tried where its longest word, likely its rarest, is found.
    needed: dict[int, list[frozenset[int]]] = {}
    for phrase in phrases:
        needed.setdefault(values[max(phrase, key=len)], []).append(frozenset(values[word] for word in phrase))

    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(values)
        part = regex.compile(_WORD_CHAR)
        known: dict[str, bool] = {}

        def inside(char: str) -> bool:
            if char not in known:
                known[char] = part.match(char) is not None
            return known[char]

        def holds(text: str) -> bool:
            found = set()
            for last, (size, value) in automaton.iter(text):
                before, after = last - size, last + 1
                if value in found or (before >= 0 and inside(text[before])):
                    continue
                if after == len(text) or not inside(text[after]):
                    found.add(value)
            return any(phrase <= found for value in found for phrase in needed.get(value, ()))

        for batch in texts:
            yield pd.Series([bool(text) and holds(text) for text in batch], dtype=bool)

    find.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(find, "boolean")(haystack)
