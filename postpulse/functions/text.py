"""Text expressions: tokens, lengths, cleaning and client-app anchors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words the word metrics ignore ("a" is listed twice and the
# empty string is an entry of its own).
STOP_WORDS = (
    "a", "be", "to", "i", "am", "of", "it", "t", "s", "and", "a", "in", "the",
    "is", "that", "an", "on", "https", "co", "this", "", "so", "have", "they",
    "what", "at", "by", "m", "are", "has", "me", "re", "he", "for", "you",
    "with",
)

# Patterns and character classes.
WORD_BREAK = r"\W+"
SOURCE_ANCHOR = r'\A<a href="([^"]+)"([^>]*)>(.+?)</a>\z'
DROPPED_BY_CLEANING = (
    r"[^\p{L}\p{N}\p{Z}\p{Sm}\p{Sc}\p{Sk}\p{Pi}\p{Pf}\p{Pc}\p{Mc}\p{Cf}\p{Cs}]"
)
NON_ASCII = r"[^\p{ASCII}]"


def tokens(text: Column) -> Column:
    """Lower-case pieces between runs of non-word characters; a piece can be ''."""
    return F.split(F.lower(text), WORD_BREAK)


def is_counted_word(word: Column) -> Column:
    return ~word.isin(*STOP_WORDS)


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units. Pure ASCII, the common case, needs no re-encoding."""
    octets = F.octet_length(text)
    return F.when(F.length(text) == octets, octets).otherwise(
        F.call_function("div", F.octet_length(F.encode(text, "UTF-16BE")), F.lit(2)).cast("int")
    )


def source_links(source: Column) -> Column:
    """The target of a client-app anchor; empty when the value is not one anchor."""
    return F.regexp_extract_all(source, F.lit(SOURCE_ANCHOR), F.lit(1))


def source_apps(source: Column) -> Column:
    """The name inside a client-app anchor; empty when the value is not one anchor.

    An array of at most one name. Exploding it drops the other rows without a
    filter, which Spark would move below, matching the pattern twice.
    """
    return F.regexp_extract_all(source, F.lit(SOURCE_ANCHOR), F.lit(3))


def clean_text(text: Column) -> Column:
    return F.regexp_replace(text, DROPPED_BY_CLEANING, "")


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, NON_ASCII, "")


def hashtag(tag: Column) -> Column:
    return F.concat(F.lit("#"), F.lower(tag))
