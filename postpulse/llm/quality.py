"""Quality rules by distribution divergence.

A document is compared with its language: the Jensen-Shannon distance between
its histogram of character classes and the language's, and likewise between
the histograms of the language's common words. The references are counted over
all documents that pass the plain rules. Documents that are too short for a
histogram (``guard_letters``, ``guard_words``) aren't judged by it. One that is
far from its own language is compared with the others and takes the nearest:
mixed and mislabelled texts are no junk.

How far a text without any common word is from a language depends on the share
of its words that are common (at 38 % it is 0.47), so the word limit is a part
of that distance, for each language its own. A language whose common words are
so rare that a text of its length may lack them by chance (``guard_common``)
judges that text by its characters alone.

Defined results: null and empty texts have no words and fail the plain rules;
a document whose language is null, or was seen too rarely to have a reference
(also among more than ``max_languages``), is compared with all references and takes the nearest; a reference that can
judge it by no histogram tells nothing of it; with no reference that can,
nothing is judged by distance. Repeated rows are judged each for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lang_id import common_languages
from .words import Piece, add_columns, byte_values, pieces, span_hashes, sums_between

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Words are counted in so many hash buckets, which bounds a language's counts.
BUCKETS = 8192
SIGNALS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean"
)
#: The columns that a judgement adds.
ADDED = tuple(field.split()[0] for field in SIGNALS.split(", ")) + ("char_distance", "word_distance", "kept")


def _char_classes() -> np.ndarray:
    """Class of each byte: a letter for itself, others by kind; bytes that
    begin a longer character by the scripts they begin, the rest of it none (0)."""
    table = np.zeros(256, np.uint8)
    table[0:32] = 1  # control
    for letter in range(26):
        table[97 + letter] = 2 + letter
    table[65:91] = 28  # capitals
    table[48:58] = 29  # digits
    for byte in range(33, 127):
        if not chr(byte).isalnum():
            table[byte] = 30
    for byte in b",.":
        table[byte] = 31
    for byte in SYMBOLS.encode():
        table[byte] = 32
    table[[32]] = 33
    table[[9, 10, 11, 12, 13]] = 34
    for k, (low, high) in enumerate(
        [(0xC2, 0xC3), (0xC4, 0xCB), (0xCC, 0xCF), (0xD0, 0xD6), (0xD7, 0xDF),
         (0xE0, 0xE1), (0xE2, 0xE2), (0xE3, 0xE9), (0xEA, 0xEF), (0xF0, 0xF7)]
    ):
        table[low : high + 1] = 35 + k
    return table


CHAR_CLASS = _char_classes()
CLASSES = 45
_LETTERS = np.isin(np.arange(CLASSES), [*range(2, 29), *range(35, 45)])


def _folded_bytes() -> np.ndarray:
    """Byte values that take capitals as small letters."""
    values = byte_values(7)
    values[65:91] = values[97:123]
    return values


_FOLDED = _folded_bytes()
_PUNCTUATION = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    #: Guards: fewer letters, or words, aren't judged by a histogram.
    guard_letters: int = 400
    guard_words: int = 100
    #: Words are judged where so many common ones are expected.
    guard_common: int = 30
    #: Largest Jensen-Shannon distance (0 to 1) of a kept document's characters.
    max_char_distance: float = 0.35
    #: Of its words: as a part of the distance of a text without common words.
    max_word_part: float = 0.85
    common_words: int = 64
    #: A language with fewer words in all has no reference.
    reference_words: int = 2000
    max_languages: int = 1000


def repeated_words(piece: Piece, size: int = WINDOW) -> np.ndarray:
    """Per text, the words that lie in windows found twice or more in it."""
    hashes, first = piece.window_hashes(piece.word_hashes(), size)
    docs = piece.word_docs()[first].astype(np.uint64)
    keys = hashes ^ (docs * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(piece.starts) + 1, np.int64)
    np.add.at(change, first[twice], 1)
    np.add.at(change, first[twice] + size, -1)
    return sums_between(np.cumsum(change[:-1]) > 0, piece.word_bounds)


def repeated_lines(piece: Piece) -> np.ndarray:
    """Per text, the lines that have a word and equal an earlier line of it."""
    n = len(piece.bounds) - 1
    breaks = np.flatnonzero(piece.data == 10)
    starts = np.sort(np.concatenate([piece.bounds[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([piece.bounds[1:], breaks]), kind="stable")
    docs = np.repeat(np.arange(n), 1 + sums_between(piece.data == 10, piece.bounds))
    words = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum(~piece.space, out=words[1:])
    has_word = words[ends] > words[starts]
    starts, ends, docs = starts[has_word], ends[has_word], docs[has_word]
    hashes = span_hashes(byte_values()[piece.data], starts, ends)
    order = np.lexsort((hashes, docs))
    again = (hashes[order][1:] == hashes[order][:-1]) & (docs[order][1:] == docs[order][:-1])
    return np.bincount(docs[order][1:][again], minlength=n)


def base_signals(piece: Piece, rules: Rules = Rules()) -> dict[str, np.ndarray]:
    n_words = piece.n_words
    chars = ((piece.data & 0xC0) != 0x80) & ~piece.space
    repeats = repeated_words(piece)
    return {
        "n_words": n_words,
        "word_chars": sums_between(chars, piece.bounds),
        "n_symbols": sums_between(_SYMBOL[piece.data], piece.bounds),
        "n_dup_lines": repeated_lines(piece),
        "n_repeat_words": repeats,
        "base_failed": (n_words < rules.min_words)
        | (100 * repeats > rules.max_repeat_percent * n_words),
    }


def char_histograms(piece: Piece) -> np.ndarray:
    """Texts x classes."""
    n = len(piece.bounds) - 1
    docs = np.repeat(np.arange(n) * CLASSES, np.diff(piece.bounds))
    found = np.bincount(docs + CHAR_CLASS[piece.data], minlength=n * CLASSES)
    found = found.reshape(n, CLASSES)
    found[:, 0] = 0
    return found


def word_buckets(piece: Piece) -> np.ndarray:
    """Bucket of each word, without case and closing punctuation."""
    ends = piece.ends.copy()
    for _ in range(3):
        ends -= (ends > piece.starts) & _PUNCTUATION[piece.data[ends - 1]]
    hashes = span_hashes(_FOLDED[piece.data], piece.starts, ends)
    return (hashes >> np.uint64(64 - 13)).astype(np.int64)


def distances(found: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances (base 2, so 0 to 1) of histogram rows to one."""
    p = found / np.maximum(found.sum(axis=1, keepdims=True), 1)
    q = np.broadcast_to(reference / max(reference.sum(), 1), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _counts(rows: DataFrame, rules: Rules) -> DataFrame:
    """(lang, kind, bucket, n): counts over the documents that pass the plain
    rules; a task sums all it reads, so few rows leave it."""

    def run(batches):
        chars: dict[str, np.ndarray] = {}
        words: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for piece in pieces(batch.column("text")):
                good = ~base_signals(piece, rules)["base_failed"]
                histograms, buckets = char_histograms(piece), word_buckets(piece)
                own = np.array(langs[piece.lo : piece.hi], object)
                for lang in {x for x in own if x is not None}:
                    mine = good & (own == lang)
                    chars[lang] = chars.get(lang, 0) + histograms[mine].sum(axis=0)
                    found = buckets[np.repeat(mine, piece.n_words)]
                    words[lang] = words.get(lang, 0) + np.bincount(found, minlength=BUCKETS)
        for kind, counted in (("char", chars), ("word", words)):
            for lang, counts in counted.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.string()),
                     pa.array(at.astype(np.int32)), pa.array(counts[at])],
                    names=["lang", "kind", "bucket", "n"],
                )

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, kind string, bucket int, n long")
    return counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, rules: Rules = Rules()) -> dict[str, tuple]:
    """By language: the character histogram, the buckets of the common words,
    and their histogram (the last entry: all other words).

    What comes to the driver is bounded: ``max_languages`` times the classes
    and buckets. Of more languages, those of the fewest rows have no reference."""
    rows = _counts(common_languages(docs.select("lang", "text"), rules.max_languages), rules).toPandas()
    found = {}
    for lang, own in rows.groupby("lang"):
        chars, words = np.zeros(CLASSES), np.zeros(BUCKETS)
        for kind, target in (("char", chars), ("word", words)):
            part = own[own["kind"] == kind]
            target[part["bucket"]] = part["n"]
        if words.sum() >= rules.reference_words:
            common = np.lexsort((np.arange(BUCKETS), -words))[: rules.common_words]
            found[lang] = (chars, common, np.append(words[common], words.sum() - words[common].sum()))
    return found


def word_rule(words: np.ndarray, rules: Rules = Rules()) -> tuple[float, float]:
    """The fewest words of a text that a reference's common words can judge, and
    the largest distance of a kept one."""
    common = 1 - words[-1] / max(words.sum(), 1)
    least = max(rules.guard_words, rules.guard_common / common if common else np.inf)
    none = np.zeros((1, len(words)))
    none[0, -1] = 1
    return least, rules.max_word_part * float(distances(none, words)[0])


def _word_histograms(piece: Piece, buckets: np.ndarray, common: np.ndarray) -> np.ndarray:
    n, k = len(piece.n_words), len(common)
    place = np.full(BUCKETS, k)
    place[common] = np.arange(k)
    at = np.repeat(np.arange(n) * (k + 1), piece.n_words) + place[buckets]
    return np.bincount(at, minlength=n * (k + 1)).reshape(n, k + 1)


def judge(docs: DataFrame, found: dict[str, tuple], rules: Rules = Rules()) -> DataFrame:
    """Documents with their signals, char_distance and word_distance (null
    where not judged) and kept. Columns of these names are replaced."""
    word_rules = {lang: word_rule(words, rules) for lang, (_, _, words) in found.items()}

    def compute(batch: pa.RecordBatch) -> dict[str, object]:
        langs = np.array(batch.column("lang").to_pylist(), object)
        parts = []
        for piece in pieces(batch.column("text")):
            signals = base_signals(piece, rules)
            n = len(piece.n_words)
            histograms, buckets = char_histograms(piece), word_buckets(piece)
            letters = histograms[:, _LETTERS].sum(axis=1)
            own = langs[piece.lo : piece.hi]
            known = np.array([x in found for x in own], bool)
            char_d, word_d = np.full(n, np.nan), np.full(n, np.nan)
            few_letters = letters < rules.guard_letters
            worst = np.full(n, np.inf)

            def compare(lang: str, mine: np.ndarray) -> None:
                """Notes the distances to a language where they are the nearest."""
                chars, common, words = found[lang]
                least, limit = word_rules[lang]
                few_words = signals["n_words"] < least
                mine = mine & ~(few_letters & few_words)
                no_char, no_word = few_letters[mine], few_words[mine]
                char = np.where(no_char, np.nan, distances(histograms[mine], chars))
                word = np.where(no_word, np.nan, distances(_word_histograms(piece, buckets, common)[mine], words))
                ratio = np.fmax(char / rules.max_char_distance, word / limit if limit else word)
                near = ratio < worst[mine]
                at = np.flatnonzero(mine)[near]
                worst[at], char_d[at], word_d[at] = ratio[near], char[near], word[near]

            for lang in {x for x in own[known]}:
                compare(lang, own == lang)
            # Far from its own language, a text may still be in another one. One
            # that its own can't judge isn't judged by others.
            unsure = known & ~np.isfinite(worst)
            for lang in found:
                mine = (worst > 1) & (own != lang) & ~unsure
                if mine.any():
                    compare(lang, mine)
            far = np.isfinite(worst) & (worst > 1)
            signals |= {"char_distance": char_d, "word_distance": word_d}
            signals["kept"] = ~signals["base_failed"] & ~far
            parts.append(signals)
        made = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        for k in ("char_distance", "word_distance"):
            made[k] = pa.array(made[k], from_pandas=True)
        return made

    fields = f"{SIGNALS}, char_distance double, word_distance double, kept boolean"
    return add_columns(docs, fields, compute)


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Documents (text, lang and any others) with signals and verdict."""
    return judge(docs, references(docs, rules), rules)
